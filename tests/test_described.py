"""Origins, schemes, rules, held-out precision, tax ids, reasons, attributes and the payment mix on literal rows and brute force."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillstar.operators import evaluation, metrics, recommend, star, survivorship, vocabulary

SERIES = "k string, mes date, unidades double"


def month(n):
    return date(2020 + n // 12, n % 12 + 1, 1)


def series(months=30, names=("a", "b", None)):
    rng = random.Random(1)
    return {k: [float(rng.randrange(20)) for _ in range(months)] for k in names}


def frame(spark, values):
    return spark.createDataFrame([(k, month(t), v) for k, u in values.items() for t, v in enumerate(u)], SERIES)


def plain_origins(values, origins, horizon, window):
    out = []
    for k, u in values.items():
        for o in range(max(0, len(u) - horizon - origins), len(u) - horizon):
            known = u[:o + 1]
            for h in range(1, horizon + 1):
                mean = sum(known[-window:]) / window if o + 1 >= window else None
                year = known[o + h - 12] if h <= 12 and o + h >= 12 else None
                out += [(k, month(o), h, month(o + h), u[o + h], m, f) for m, f in (("moving_average", mean), ("seasonal_naive", year), ("naive", known[-1]))]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("months", "origins", "horizon", "window"), [(30, 12, 3, 3), (8, 12, 2, 4), (40, 5, 14, 3), (2, 3, 3, 3)])
def test_origins_against_a_loop(spark, months, origins, horizon, window):
    values = series(months)
    got = evaluation.rolling_origin(frame(spark, values), origins, horizon, window, ["k"])
    have = rows(got, "k", "origem", "passo", "mes", "unidades", "modelo", "previsto")
    want = plain_origins(values, origins, horizon, window)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:6] == b[:6] and (a[6] == b[6] if None in (a[6], b[6]) else abs(a[6] - b[6]) < 1e-9)


@pytest.mark.parametrize(("months", "origins", "horizon", "window"), [(60, 12, 3, 3), (60, 4, 2, 15), (20, 12, 3, 3), (5, 12, 3, 3)])
def test_errors_of_the_months_seen(spark, months, origins, horizon, window):
    """The months that no origin looks at are not made, and the errors are those of the whole series."""
    values = series(months) | {"early": [3.0] + [0.0] * (months - 1)}
    sold = frame(spark, {k: [x or None for x in u] for k, u in values.items()}).filter("unidades is not null")
    first = spark.createDataFrame([(month(0),)], "first_month date")
    seen = evaluation.months_seen(origins, horizon, window)
    dense = evaluation.dense_series(sold, ["k"], first, month(months - 1), seen)
    assert dense.count() == len(values) * min(months, seen)
    got = rows(evaluation.rolling_errors(dense, origins, horizon, window, ["k"]), "origem", "modelo", "previsoes", "mae")
    want = rows(evaluation.origin_errors(evaluation.rolling_origin(frame(spark, values), origins, horizon, window, ["k"])), "origem", "modelo", "previsoes", "mae")
    assert [a[:3] for a in got] == [a[:3] for a in want] and len(got) == 3 * min(origins, months - horizon)
    assert [a[3] for a in got] == pytest.approx([a[3] for a in want], nan_ok=True)


def test_an_origin_sees_nothing_after_it(spark):
    values = series(30, ("a",))
    changed = {"a": values["a"][:20] + [x + 100 for x in values["a"][20:]]}
    before, after = (rows(evaluation.rolling_origin(frame(spark, v), 12, 3, 3, ["k"]).filter(F.col("origem") < month(20)), "origem", "passo", "modelo", "previsto") for v in (values, changed))
    assert before == after and len(before) > 0


def test_summary_of_models(spark):
    errors = [(month(0), "moving_average", 1.0), (month(0), "seasonal_naive", 1.0), (month(0), "naive", 2.0), (month(1), "moving_average", 4.0),
              (month(1), "seasonal_naive", None), (month(1), "naive", 3.0)]
    got = {r.modelo: r for r in evaluation.model_summary(spark.createDataFrame(errors, "origem date, modelo string, mae double")).collect()}
    assert [(got[m].origens, got[m].media_mae, got[m].vitorias, got[m].melhor) for m in ("moving_average", "seasonal_naive", "naive")] == [
        (2, 2.5, 1, False), (1, 1.0, 0, True), (2, 2.5, 1, False)]
    assert got["naive"].desvio_mae == pytest.approx(statistics.stdev([2.0, 3.0]))
    assert evaluation.model_summary(evaluation.origin_errors(evaluation.rolling_origin(spark.createDataFrame([], SERIES), keys=["k"]))).count() == 0


def test_schemes_against_a_loop(spark):
    values, window, horizon = series(16), 3, 4
    values["short"] = [0.0] * 9 + [6.0] + [1.0] * 6
    got = {(r.k, r.mes): r for r in evaluation.averaging_schemes(frame(spark, values), month(11), horizon, window, ["k"]).collect()}
    assert len(got) == 4 * horizon
    for k, u in values.items():
        known = u[:12]
        for h in range(horizon):
            row = got[k, month(12 + h)]
            assert row.recursiva == pytest.approx(sum(known[-window:]) / window)
            known.append(sum(known[-window:]) / window)
            assert row.estatica == pytest.approx(sum(u[9:12]) / window) and row.movel == pytest.approx(sum(u[9 + h:12 + h]) / window)
            assert row.movel_usa_teste == (h > 0)
    totals = {r.esquema: r for r in evaluation.scheme_totals(evaluation.averaging_schemes(frame(spark, values), month(11), horizon, window, ["k"])).collect()}
    assert {e: t.eh_previsao for e, t in totals.items()} == {"estatica": True, "recursiva": True, "movel": False}
    # A series of one month is averaged as it is; one without training months has no forecast.
    few = spark.createDataFrame([("x", month(11), 5.0), ("x", month(12), 1.0), ("y", month(12), 1.0)], SERIES)
    assert rows(evaluation.averaging_schemes(few, month(11), 1, window, ["k"]), "k", "recursiva") == [("x", 5.0), ("y", None)]


def test_dense_series_fills_months_and_keeps_null_keys(spark):
    sold = spark.createDataFrame([("a", month(1), 3.0), (None, month(2), None)], SERIES)
    first = spark.createDataFrame([(month(0),)], "first_month date")
    got = rows(evaluation.dense_series(sold, ["k"], first, month(2)))
    assert got == sorted([("a", month(0), 0.0), ("a", month(1), 3.0), ("a", month(2), 0.0), (None, month(0), 0.0), (None, month(1), 0.0), (None, month(2), 0.0)], key=repr)


def baskets():
    rng = random.Random(4)
    out = [(o, rng.choice([1, 1, 2, 3, 4, 5, 6, 7])) for o in range(200) for _ in range(rng.randrange(1, 5))]
    return out + [(500, i) for i in range(60)] * 2 + [(None, 1), (501, None), (502, 99)]


@pytest.mark.parametrize("least", [1, 3, 10_000])
def test_rules_against_all_pairs(spark, least):
    """One basket holds all items, twice; orders and items may be null."""
    lines = baskets()
    sets = defaultdict(set)
    for o, i in lines:
        if o is not None and i is not None:
            sets[o].add(i)
    count = Counter(i for s in sets.values() for i in s)
    want = []
    for ref in (1, 5, 99):
        for item in set(count) - {ref}:
            both = sum(ref in s and item in s for s in sets.values())
            if both >= least:
                n = len(sets)
                want.append((ref, item, n, count[ref], count[item], both, both / n, both / count[ref], both * n / (count[ref] * count[item])))
    df = spark.createDataFrame([(o, i, "x") for o, i in lines], "order_id long, product_id long, lift string")
    references = spark.createDataFrame([(1,), (5,), (5,), (99,), (12345,)], "item long")
    rules = recommend.basket_rules(df, references, least)
    assert rows(rules) == sorted(want, key=repr)
    top = rows(recommend.top_rules(rules, 2), "reference", "item", "posicao")
    best = sorted(want, key=lambda r: (r[0], -r[8], -r[5], r[1]))
    assert top == sorted([(ref, r[1], n + 1) for ref in (1, 5, 99) for n, r in enumerate([r for r in best if r[0] == ref][:2])], key=repr)
    assert recommend.basket_rules(df.limit(0), references, least).count() == 0


def plain_precision(purchases, refs, k):
    orders = defaultdict(set)
    for c, i, o, ts in purchases:
        if None not in (c, i, o):
            orders[c].add((ts, o))
    last = {c: max(o) for c, o in orders.items()}
    history, held, seen = defaultdict(set), defaultdict(set), defaultdict(list)
    for c, i, o, ts in purchases:
        if None not in (c, i, o):
            if (ts, o) == last[c]:
                held[c].add(i)
            else:
                history[c].add(i)
                seen[c].append((ts, -i))
    buyers = Counter(i for s in history.values() for i in s)
    popular = sorted(buyers, key=lambda i: (-buyers[i], i))

    def similar(ref):
        common = Counter(i for s in history.values() if ref in s for i in s if i != ref)
        return sorted(common, key=lambda i: (-common[i] / (buyers[ref] * buyers[i]) ** 0.5, i))

    judged = {c: -max(x for x in seen[c] if -x[1] in refs)[1] for c in last if history[c] & refs}
    hits = lambda lists: sum(len(set([i for i in lists(c) if i not in history[c]][:k]) & held[c]) for c in judged)
    alone = sum(len(o) == 1 for o in orders.values())
    return (k, len(last), alone, len(last) - alone - len(judged), len(judged), hits(lambda c: similar(judged[c])), hits(lambda c: popular))


def test_precision_against_a_loop(spark):
    rng = random.Random(9)
    day = datetime(2020, 1, 1)
    purchases = [(c, rng.choice([1, 1, 2, 2, 3, 4, 5, 6, *range(7, 30)]), 100 * c + o, day + timedelta(days=o // 2)) for c in range(80) for o in range(rng.randrange(1, 6)) for _ in range(3)]
    purchases += [(900, i, 90_000 + i, day) for i in range(30)] + [(None, 1, 5, day), (901, None, 6, day), (902, 3, None, day)]
    df = spark.createDataFrame([(*p, 1) for p in purchases], "customer_id long, product_id long, order_id long, data_pedido timestamp, position int")
    for refs in ({1, 4}, {29}, set()):
        got = recommend.precision_at_k(df, spark.createDataFrame([(i,) for i in refs], "item long"), 3).first()
        want = plain_precision(purchases, refs, 3)
        assert (got.k, got.clientes, got.sem_historico, got.sem_referencia, got.julgados, got.acertos_modelo, got.acertos_popularidade) == want
        assert got.precisao_modelo == (want[5] / (3 * want[4]) if want[4] else None)
    empty = recommend.precision_at_k(df.limit(0), spark.createDataFrame([(1,)], "item long")).first()
    assert (empty.clientes, empty.julgados, empty.precisao_modelo) == (0, 0, None)


def test_precision_copies_no_list_for_a_customer(spark, monkeypatch):
    """However many items are recommended, no stored table outgrows the purchases."""
    rng = random.Random(4)
    day = datetime(2020, 1, 1)
    purchases = [(c, rng.randrange(12), 10 * c + o, day + timedelta(days=o)) for c in range(40) for o in range(4)]
    df = spark.createDataFrame(purchases, "customer_id long, product_id long, order_id long, data_pedido timestamp")
    sizes, keep = [], recommend.kept_table

    def counted(frame, name):
        kept = keep(frame, name)
        sizes.append(kept.count())
        return kept

    monkeypatch.setattr(recommend, "kept_table", counted)
    got = recommend.precision_at_k(df, spark.createDataFrame([(1,), (2,)], "item long"), 500).first()
    assert (got.julgados, got.acertos_modelo, got.acertos_popularidade) == plain_precision(purchases, {1, 2}, 500)[4:]
    assert got.julgados > 0 and max(sizes) <= len(purchases)


PEOPLE = "id long, tax_id string, name string, email string, created_at timestamp"


def test_tax_ids(spark):
    old, new = datetime(2019, 1, 1), datetime(2021, 1, 1)
    people = [(1, "012.345", "Ana", None, new), (2, "012345", None, "b@x", new), (3, " 012345 ", "Cy", "c@x", new), (4, "fr-77", "D", None, new), (5, "FR77", "E", None, old),
              (6, "FR77", "F", None, None), (7, None, "G", "g@x", old), (8, None, "G", "g@x", old), (9, "n/a", None, None, None), (10, "0000", "H", None, old), (11, "  ", "I", None, old)]
    df = spark.createDataFrame(people, PEOPLE)
    walk = survivorship.tax_id_crosswalk(df, ["name", "email"])
    assert rows(walk, "id", "kept_id", "tax_key", "linhas") == sorted(
        [(1, 3, "012345", 3), (2, 3, "012345", 3), (3, 3, "012345", 3), (4, 5, "FR77", 3), (5, 5, "FR77", 3), (6, 5, "FR77", 3)]
        + [(i, i, None, 1) for i in (7, 8, 9, 10, 11)], key=repr)
    stay = {r.id: r for r in survivorship.surviving_rows(df, walk, ["name", "email"]).collect()}
    assert (stay[3].name, stay[3].email, stay[3].linhas, stay[3].preenchidas) == ("Cy", "c@x", 3, 0)
    assert (stay[5].name, stay[5].email, stay[9].name) == ("E", None, None) and len(stay) == 7
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (6, 1), (77, 5), (None, 7)], "customer_id long, total int")
    assert rows(survivorship.follow(fact, walk, "customer_id")) == sorted([(3, 10), (3, 20), (3, 30), (5, 1), (77, 5), (None, 7)], key=repr)
    proof = {r.quando: r for r in survivorship.follow_proof(fact, walk, "customer_id", "total").collect()}
    assert (proof["antes"].linhas, proof["antes"].soma) == (proof["depois"].linhas, proof["depois"].soma) == (6, 73)
    assert (proof["antes"].chaves, proof["depois"].chaves) == (5, 3)
    # A value that only another row knows is taken from it, and counted.
    gap = spark.createDataFrame([(1, "9", "A", None, old), (2, "9", None, "z@x", old)], PEOPLE)
    filled = survivorship.surviving_rows(gap, survivorship.tax_id_crosswalk(gap, ["name", "email"]), ["name", "email"]).collect()
    assert [tuple(r) for r in filled] == [(1, "A", "z@x", 2, 1)]
    assert survivorship.tax_id_crosswalk(df.limit(0), ["name"]).count() == 0


CLASSES = {"defeito": ["com defeito"], "atraso na entrega": ["demora"], "tamanho": ["tamanha cor"], "tamanco": []}


@pytest.mark.parametrize(("value", "found", "rule", "edits"), [
    ("Defeito", "defeito", "exata", None), ("  DEFEITO!! ", "defeito", "exata", None), ("defêito", "defeito", "exata", None), ("com  defeito", "defeito", "variante", None),
    ("defeto", "defeito", "distancia", 1), ("defxx", None, "sem_classe", None), ("atrazo na entregra", "atraso na entrega", "distancia", 2), ("demorra", "atraso na entrega", "distancia", 1),
    ("tamanso", None, "ambigua", 1), (None, None, "nulo", None), (" n/a ", None, "nulo", None), ("...!", None, "nulo", None), ("x", None, "sem_classe", None)])
def test_reasons(spark, value, found, rule, edits):
    got = vocabulary.canonical_values(spark.createDataFrame([(value,), (value,)], "r string"), "r", CLASSES).first()
    assert (got.valor, got.linhas, got.classe, got.regra, got.edicoes) == (value, 2, found, rule, edits)


def test_reasons_lose_no_row(spark):
    df = spark.createDataFrame([(1, "defeto", "z"), (2, None, "z"), (3, "what", "z"), (4, "defeto", "z")], "id int, r string, valor string")
    values = vocabulary.canonical_values(df, "r", CLASSES)
    assert rows(vocabulary.with_class(df, "r", values), "id", "classe") == sorted([(1, "defeito"), (2, None), (3, None), (4, "defeito")], key=repr)
    assert vocabulary.canonical_values(df.limit(0), "r", CLASSES).count() == 0


def test_attributes(spark):
    data = [(1, " Peso", "1,5", 1), (1, "peso", "2.5", 2), (1, "peso", "heavy", 3), (1, "Cor", " azul ", 1), (1, "cor", "azul", 1), (2, "ATIVO", "Não", 1), (2, "ativo", "talvez", 2),
            (2, "novo", "?", 1), (2, None, "?", 1), (3, "peso", None, 1), (3, "peso", " ", 2), (None, "peso", "7", 1), (4, "peso", "3", 5), (4, "peso", "3.0", 5)]
    df = spark.createDataFrame(data, "id long, nome string, valor string, seq int")
    declared = {"peso": "double", "ativo": "boolean", "cor": "string", "lote": "bigint"}
    got = rows(vocabulary.unpack_attributes(df, declared, "id", "nome", "valor", "seq"))
    assert got == sorted([(1, 2.5, None, "azul", None, 1, 1, 0), (2, None, False, None, None, 0, 1, 2), (3, None, None, None, None, 0, 0, 0), (None, 7.0, None, None, None, 0, 0, 0),
                          (4, 3.0, None, None, None, 0, 0, 0)], key=repr)
    assert rows(vocabulary.undeclared_names(df, declared, "nome", "valor")) == sorted([("novo", 1, "?"), (None, 1, "?")], key=repr)
    assert vocabulary.unpack_attributes(df.limit(0), declared, "id", "nome", "valor", "seq").count() == 0


def test_attribute_rows_are_dealt_before_they_are_sorted(spark):
    df = spark.createDataFrame([(1, "peso", "1", 1)], "id long, nome string, valor string, seq int")
    plan = vocabulary.unpack_attributes(df, {"peso": "double"}, "id", "nome", "valor", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange"):] and "Sort" not in plan[plan.index("Exchange"):]


def test_payment_mix_adds_up_and_stays_isolated(spark):
    paid = spark.createDataFrame([("pix", 1, 10.0), ("card", 3, 30.0), ("card", 1, 50.0), (None, 1, 10.0)], "metodo string, parcelas int, valor double")
    got = metrics.mix({"fct_pagamento": paid}, ["payments", "payment_value"], ["fct_pagamento.metodo"]).collect()
    assert {r.metodo: (r.payments, r.payment_value, r.share_payments, r.share_payment_value) for r in got} == {
        "pix": (1, 10.0, 0.25, 0.1), "card": (2, 80.0, 0.5, 0.8), None: (1, 10.0, 0.25, 0.1)}
    assert sum(r.share_payment_value for r in got) == pytest.approx(1)
    assert metrics.mix({"fct_pagamento": paid.limit(0)}, ["payments"], ["fct_pagamento.metodo"]).count() == 0
    orders = spark.createDataFrame([("paid",)], "status string")
    for by, filters in ((["dim_status_pedido.status"], None), (["fct_pagamento.metodo"], {"dim_data.ano": [2020]})):
        with pytest.raises(star.UnrelatedError):
            metrics.mix({"fct_pagamento": paid, "dim_status_pedido": orders, "dim_data": orders}, ["payments"], by, filters)
