"""A named set of tables, each built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping[str, DataFrame]):
    """Frames by name. Building one touches only the files it needs."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            builder = self._builders[name]
            self._built[name] = builder if isinstance(builder, DataFrame) else builder()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
