"""Item-to-item similarity over who bought what, and items sharing an order.

Interactions stay a long table of distinct (customer, item) pairs; the dense customer-by-item
matrix they stand for is never built.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.text import homonym_label, is_suspicious_label
from tillstar.operators.ranking import number_all_rows, top_k_positions
from tillstar.operators.skew import with_group_totals


def interactions(rows: DataFrame, customer: str = "customer_id", item: str = "product_id") -> DataFrame:
    """Who bought what at least once; how much does not matter."""
    return rows.select(F.col(customer).alias("customer_id"), F.col(item).alias("item")).filter(
        "customer_id is not null and item is not null"
    ).distinct()


def matrix_summary(pairs: DataFrame, reference) -> DataFrame:
    """Size and density of the interaction matrix, and the buyers of the reference item."""
    per_item = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("buyers"))
    customers = pairs.select("customer_id").distinct().agg(F.count(F.lit(1))).scalar()
    sizes = per_item.agg(
        F.count(F.lit(1)).alias("produtos"),
        F.sum("buyers").alias("celulas"),
        F.avg("buyers").alias("compradores_por_produto"),
        F.max(F.when(F.col("item") == reference, F.col("buyers"))).alias("compradores_da_referencia"),
    ).withColumn("clientes", customers)
    density = F.lit(100.0) * F.col("celulas") / (F.col("clientes") * F.col("produtos"))
    return sizes.select(
        "clientes", "produtos", density.alias("densidade_pct"),
        "compradores_por_produto", "compradores_da_referencia",
    )


def cosine(common: Column, first: Column, second: Column) -> Column:
    """Cosine of two binary vectors: shared buyers over the root of the product of both counts."""
    norm = F.sqrt(first.cast("double") * second.cast("double"))
    return F.try_divide(common.cast("double"), norm)


def similar_to(pairs: DataFrame, reference) -> DataFrame:
    """Every other item with its cosine to ``reference``; work is linear in the pairs.

    Each pair learns whether its customer bought the reference; one aggregate per item then
    gives both its buyers and the shared ones. Items sharing no buyer have similarity 0.
    """
    buyers = pairs.filter(F.col("item") == reference).select("customer_id", F.lit(True).alias("_ref"))
    counts = pairs.join(buyers, "customer_id", "left").groupBy("item").agg(
        F.count(F.lit(1)).alias("compradores"), F.count("_ref").alias("comuns")
    )
    total = pairs.filter(F.col("item") == reference).agg(F.count(F.lit(1))).scalar()
    return (
        counts.filter(F.col("item") != reference)
        .withColumn("similaridade", cosine(F.col("comuns"), F.col("compradores"), total))
        .filter(F.col("similaridade").isNotNull())
    )


def labels(products: DataFrame) -> DataFrame:
    """Display labels: the name, with the id added where several products share it."""
    counted = with_group_totals(
        products.select("id", "name"), ["name"], F.count(F.lit(1)).alias("_same_name")
    )
    return counted.select(
        F.col("id").alias("item"), homonym_label("id", "name", "_same_name").alias("produto")
    )


def _by_similarity() -> tuple[Column, ...]:
    return F.desc("similaridade"), F.asc("item")


def ranking(similar: DataFrame, names: DataFrame, n: int) -> DataFrame:
    """The n most similar items, ties by id, with a mark on names that are catalogue junk."""
    top = top_k_positions(similar, _by_similarity(), n, "posicao")
    return top.join(names, "item").select(
        "posicao", F.col("item").alias("product_id"), "produto", "similaridade",
        is_suspicious_label("produto").alias("suspeito"),
    )


def spread(similar: DataFrame) -> DataFrame:
    """One row: mean, sample deviation and maximum of the similarities, and how many there are."""
    return similar.agg(
        F.count(F.lit(1)).alias("itens"),
        F.avg("similaridade").alias("media"),
        F.stddev_samp("similaridade").alias("desvio"),
        F.max("similaridade").alias("maximo"),
    )


def distinguishability(similar: DataFrame, n: int = 5) -> DataFrame:
    """The top n with their distance from the mean in deviations, and the gap to the next."""
    stats = spread(similar).select(F.struct("media", "desvio")).scalar()
    top = top_k_positions(similar, _by_similarity(), n, "posicao").withColumn("_s", stats)
    gap = F.col("similaridade") - F.lead("similaridade").over(Window.orderBy("posicao"))
    return top.select(
        "posicao", F.col("item").alias("product_id"), "similaridade",
        F.try_divide(F.col("similaridade") - F.col("_s.media"), F.col("_s.desvio")).alias("desvios_da_media"),
        gap.alias("gap"),
        (F.lit(100.0) * F.try_divide(gap, F.col("similaridade"))).alias("gap_pct"),
    )


def top_by_subset(rows: DataFrame, reference, subsets: Mapping[str, Column], item: str = "product_id") -> DataFrame:
    """The most similar item under each subset of the rows, in one job.

    A (customer, item) pair carries one flag per subset, so the rows are read and shuffled once
    however many subsets there are. A subset without the reference item gives no row.
    """
    names = list(subsets)
    flags = [F.max(condition.cast("int")).alias(f"in_{i}") for i, condition in enumerate(subsets.values())]
    pairs = rows.filter(F.col("customer_id").isNotNull() & F.col(item).isNotNull()).groupBy(
        "customer_id", F.col(item).alias("item")
    ).agg(*flags)
    buyers = pairs.filter(F.col("item") == reference).select(
        "customer_id", *[F.col(f"in_{i}").alias(f"ref_{i}") for i in range(len(names))]
    )
    both = [F.sum(F.coalesce(F.col(f"in_{i}") * F.col(f"ref_{i}"), F.lit(0))).alias(f"common_{i}") for i in range(len(names))]
    counts = pairs.join(buyers, "customer_id", "left").groupBy("item").agg(
        *[F.sum(f"in_{i}").alias(f"n_{i}") for i in range(len(names))], *both
    )
    per_subset = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(name).alias("recorte"), F.col(f"n_{i}").alias("n"), F.col(f"common_{i}").alias("comuns"))
        for i, name in enumerate(names)
    ]))
    long = counts.select("item", per_subset.alias("s")).select("item", "s.*").filter("n > 0")
    sizes = F.max(F.when(F.col("item") == reference, F.col("n")))
    reference_sizes = long.groupBy("i").agg(sizes.alias("ref_n")).filter("ref_n is not null")
    # One row per subset.
    scored = long.filter(F.col("item") != reference).join(F.broadcast(reference_sizes), "i").withColumn(
        "similaridade", cosine(F.col("comuns"), F.col("n"), F.col("ref_n"))
    )
    best = F.max(F.struct(F.col("similaridade"), (-F.col("item")).alias("minus_item")))
    return scored.groupBy("i", "recorte").agg(best.alias("b")).select(
        "recorte", (-F.col("b.minus_item")).alias("product_id"), F.col("b.similaridade").alias("similaridade")
    )


def name_trap(rows: DataFrame, reference_name: str, n: int = 3) -> DataFrame:
    """The ranking that comes out when items are told apart by name, which fuses homonyms."""
    similar = similar_to(interactions(rows, item="produto"), reference_name)
    return top_k_positions(similar, _by_similarity(), n, "posicao").select(
        "posicao", F.col("item").alias("produto"), "similaridade",
        is_suspicious_label("item").alias("suspeito"),
    )


def fused_products(rows: DataFrame) -> DataFrame:
    """How many products disappear when names stand for ids."""
    known = rows.select("product_id", "produto").distinct()
    ids = known.select("product_id").distinct().agg(F.count(F.lit(1)).alias("por_id"))
    names = known.select("produto").filter("produto is not null").distinct().agg(F.count(F.lit(1))).scalar()
    return ids.withColumn("por_nome", names).withColumn("fundidos", F.col("por_id") - F.col("por_nome"))


def basket_counts(rows: DataFrame, reference, item: str = "product_id") -> DataFrame:
    """Distinct orders each item shares with the reference item."""
    pairs = rows.select("order_id", F.col(item).alias("item")).distinct()
    with_reference = rows.filter(F.col(item) == reference).select("order_id").distinct()
    return pairs.filter(F.col("item") != reference).join(with_reference, "order_id", "left_semi").groupBy(
        "item"
    ).agg(F.count(F.lit(1)).alias("pedidos_em_comum"))


def basket_ranking(rows: DataFrame, reference, names: DataFrame, n: int) -> DataFrame:
    top = top_k_positions(
        basket_counts(rows, reference), (F.desc("pedidos_em_comum"), F.asc("item")), n, "posicao"
    )
    return top.join(names, "item").select(
        "posicao", F.col("item").alias("product_id"), "produto", "pedidos_em_comum"
    )


def similarity_fact(
    similar: DataFrame, rows: DataFrame, reference, reference_name: str, names: DataFrame
) -> DataFrame:
    """Every other item with similarity, deviations from the mean, position and shared orders.

    ``similar`` comes from ``similar_to``; ``rows`` are the lines it was made from.
    """
    stats = spread(similar).select(F.struct("media", "desvio")).scalar()
    scored = (
        similar.select("item", "similaridade").withColumn("_s", stats)
        .join(basket_counts(rows, reference), "item", "left")
        .join(names, "item", "left")
        .select(
            "item", "produto", "similaridade",
            F.try_divide(F.col("similaridade") - F.col("_s.media"), F.col("_s.desvio")).alias("desvios_da_media"),
            F.coalesce("pedidos_em_comum", F.lit(0)).alias("pedidos_em_comum"),
        )
    )
    return number_all_rows(scored, _by_similarity(), "posicao").select(
        F.col("item").alias("product_id"), "produto", "similaridade", "desvios_da_media",
        "posicao", "pedidos_em_comum", F.lit(reference_name).alias("produto_referencia"),
    )


def cosine_rows(pairs: DataFrame, references: DataFrame) -> DataFrame:
    """Cosine of each item of ``references`` (column ``item``) to every item it shares a buyer with, itself included.

    All other items have cosine 0. Buyers of the references meet their own pairs once, so the work is linear in the
    pairs of those buyers, per reference; no product of all items with all items is built.
    """
    named = references.select(F.col("item").alias("reference")).distinct()
    buyers = pairs.join(named, F.col("item") == F.col("reference")).select("reference", "customer_id")
    common = pairs.join(buyers, "customer_id").groupBy("reference", "item").agg(F.count(F.lit(1)).alias("comuns"))
    popularity = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    own = popularity.select(F.col("item").alias("reference"), F.col("n").alias("n_reference"))
    return common.join(own, "reference").join(popularity, "item").select(
        "reference", "item", "comuns", cosine(F.col("comuns"), F.col("n_reference"), F.col("n")).alias("similaridade"))


def cosine_checks(cosines: DataFrame, references: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row of violation counts over ``cosine_rows``: values outside [0, 1], a bought reference that is not 1 to
    itself, and two references that see different values of each other."""
    itself = F.col("reference") == F.col("item")
    bought = pairs.join(references.select("item").distinct(), "item", "left_semi").select("item").distinct().agg(F.count(F.lit(1))).scalar()
    back = cosines.select(F.col("reference").alias("item"), F.col("item").alias("reference"), F.col("similaridade").alias("_back"))
    among = cosines.join(references.select("item").distinct(), "item", "left_semi")
    differ = among.join(back, ["reference", "item"], "left").agg(
        F.count_if(~F.coalesce(F.abs(F.col("similaridade") - F.col("_back")) < 1e-12, F.lit(False)))).scalar()
    return cosines.agg(
        F.count(F.lit(1)).alias("pares"),
        F.count_if((F.col("similaridade") < 0) | (F.col("similaridade") > 1 + 1e-9)).alias("fora_do_intervalo"),
        F.count_if(itself & (F.abs(F.col("similaridade") - 1) > 1e-9)).alias("diagonal_diferente_de_1"),
        F.count_if(itself).alias("_itself"),
    ).withColumn("referencias_sem_diagonal", bought - F.col("_itself")).withColumn("assimetricas", differ).drop("_itself")
