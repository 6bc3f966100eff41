"""Forecast schemes and origins, cross-sell, tax ids, reasons, attributes and the payment mix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators import evaluation, forecast, metrics, recommend, survivorship, vocabulary
from tillstar.plans.oracle_base import clean, over_ctes
from tillstar.plans.queries_models import MODEL_CTES
from tillstar.plans.registry import REFERENCE_NAME, TARGET_NAME, TEST_END, TRAIN_END, Context, query

ORIGINS, HORIZON, WINDOW = 12, 3, 3


def _sql(select: str, extra: str = "") -> str:
    return over_ctes(select, MODEL_CTES + (",\n" + extra if extra else ""))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Nine decimals, where the last bits depend on the order of summation."""
    return df.withColumns({n: F.round(n, 9) for n in names})


# Every product's dense months; forecasts of each of the last origins.
_ORIGIN_CTES = f"""
e_serie AS (
  SELECT s.product_id, m.mes, coalesce(CAST(u AS DOUBLE), 0) AS unidades FROM (SELECT DISTINCT product_id FROM m_items) s CROSS JOIN m_meses m
  LEFT JOIN (SELECT product_id, mes, sum(quantidade) AS u FROM m_items GROUP BY 1, 2) v ON v.product_id = s.product_id AND v.mes = m.mes),
e_origens AS (
  SELECT mes AS origem FROM m_meses WHERE mes <= DATE '{TEST_END}' - INTERVAL {HORIZON} MONTH AND mes > DATE '{TEST_END}' - INTERVAL {HORIZON + ORIGINS} MONTH),
e_base AS (
  SELECT o.origem, s.product_id, sum(s.unidades) FILTER (s.mes > o.origem - INTERVAL {WINDOW} MONTH) / {WINDOW} AS moving_average,
         max(s.unidades) FILTER (s.mes = o.origem) AS naive
  FROM e_origens o JOIN e_serie s ON s.mes <= o.origem GROUP BY 1, 2),
e_prev AS (
  SELECT b.origem, a.product_id, a.mes, a.unidades, b.moving_average, y.unidades AS seasonal_naive, b.naive
  FROM e_base b JOIN e_serie a ON a.product_id = b.product_id AND a.mes > b.origem AND a.mes <= b.origem + INTERVAL {HORIZON} MONTH
  LEFT JOIN e_serie y ON y.product_id = a.product_id AND y.mes = a.mes - INTERVAL 1 YEAR),
e_erros AS (
  {" UNION ALL ".join(f"SELECT origem, '{m}' AS modelo, {i} AS o, count({m}) AS previsoes, avg(abs(unidades - {m})) AS mae FROM e_prev GROUP BY 1" for i, m in enumerate(forecast.MODELS))})""".strip()


def _origin_errors(c: Context) -> DataFrame:
    monthly = c.unified.groupBy("product_id", "mes").agg(F.sum("quantidade").alias("unidades"))
    months = evaluation.months_seen(ORIGINS, HORIZON, WINDOW)
    dense = evaluation.dense_series(monthly, ["product_id"], forecast.first_month(c.raw["orders"]), TEST_END, months)
    return evaluation.rolling_errors(dense, ORIGINS, HORIZON, WINDOW, ["product_id"])


@query("forecast_rolling_origin", _sql(
    "SELECT CAST(origem AS TIMESTAMP) AS origem, modelo, previsoes, round(mae, 9) AS mae FROM e_erros", _ORIGIN_CTES))
def forecast_rolling_origin(c: Context):
    """Error of every model from each of twelve origins, over all products."""
    return _rounded(_origin_errors(c), "mae")


@query("forecast_rolling_origin_summary", _sql(
    "SELECT modelo, origens, round(media_mae, 9) AS media_mae, round(desvio_mae, 9) AS desvio_mae, round(menor_mae, 9) AS menor_mae, "
    "round(maior_mae, 9) AS maior_mae, vitorias, row_number() OVER (ORDER BY round(media_mae, 9), o) = 1 AS melhor FROM ("
    "SELECT modelo, o, count(mae) AS origens, avg(mae) AS media_mae, stddev_samp(mae) AS desvio_mae, min(mae) AS menor_mae, max(mae) AS maior_mae, "
    "count(*) FILTER (p = 1) AS vitorias FROM (SELECT *, row_number() OVER (PARTITION BY origem ORDER BY round(mae, 9), o) AS p FROM e_erros) GROUP BY 1, 2)", _ORIGIN_CTES))
def forecast_rolling_origin_summary(c: Context):
    return _rounded(evaluation.model_summary(_rounded(_origin_errors(c), "mae")), "media_mae", "desvio_mae", "menor_mae", "maior_mae")


# The target product's months after training by three readings of the same moving average.
_SCHEME_CTES = f"""
x_recursiva AS (
  WITH RECURSIVE r(n, a, b, c) AS (
    SELECT 0, max(unidades) FILTER (mes = DATE '{TRAIN_END}' - INTERVAL 2 MONTH), max(unidades) FILTER (mes = DATE '{TRAIN_END}' - INTERVAL 1 MONTH),
           max(unidades) FILTER (mes = DATE '{TRAIN_END}') FROM m_serie
    UNION ALL SELECT n + 1, b, c, (a + b + c) / 3 FROM r WHERE n < {HORIZON})
  SELECT CAST(DATE '{TRAIN_END}' + to_months(n) AS DATE) AS mes, c AS recursiva FROM r WHERE n > 0),
x_esquemas AS (
  SELECT s.mes, s.unidades, (SELECT avg(unidades) FROM m_serie WHERE eh_treino AND mes > DATE '{TRAIN_END}' - INTERVAL 3 MONTH) AS estatica, recursiva,
         (SELECT avg(unidades) FROM m_serie t WHERE t.mes < s.mes AND t.mes >= s.mes - INTERVAL 3 MONTH) AS movel,
         s.mes > DATE '{TRAIN_END}' + INTERVAL 1 MONTH AS movel_usa_teste
  FROM m_serie s JOIN x_recursiva x ON x.mes = s.mes WHERE NOT eh_treino)""".strip()


def _schemes(c: Context) -> DataFrame:
    return evaluation.averaging_schemes(c.dense, TRAIN_END, HORIZON, WINDOW)


@query("forecast_recursive_average", _sql(
    "SELECT CAST(mes AS TIMESTAMP) AS mes, unidades, round(recursiva, 9) AS recursiva FROM x_esquemas", _SCHEME_CTES))
def forecast_recursive_average(c: Context):
    return _rounded(_schemes(c).select("mes", "unidades", "recursiva"), "recursiva")


@query("forecast_rolling_average", _sql(
    "SELECT CAST(mes AS TIMESTAMP) AS mes, unidades, round(movel, 9) AS movel, movel_usa_teste FROM x_esquemas", _SCHEME_CTES))
def forecast_rolling_average(c: Context):
    """One step ahead from actual months; ``movel_usa_teste`` marks those that no forecast could know."""
    return _rounded(_schemes(c).select("mes", "unidades", "movel", "movel_usa_teste"), "movel")


@query("forecast_schemes", _sql(
    " UNION ALL ".join(
        f"SELECT '{e}' AS esquema, round(sum({e}), 9) AS soma, CAST(round_even(sum({e}), 0) AS BIGINT) AS soma_arredondada, sum(unidades) AS soma_real, "
        f"round(avg(abs(unidades - {e})), 9) AS mae, {'false' if e == 'movel' else 'true'} AS eh_previsao FROM x_esquemas" for e in evaluation.SCHEMES), _SCHEME_CTES))
def forecast_schemes(c: Context):
    return _rounded(evaluation.scheme_totals(_schemes(c)), "soma", "mae")


# Rules of the products with one of two names.
_NAMES = (REFERENCE_NAME, TARGET_NAME)
MIN_ORDERS, TOP_RULES = 2, 5
_RULE_CTES = f"""
b_cestas AS (SELECT DISTINCT order_id, product_id FROM m_items),
b_n AS (SELECT product_id, count(*) AS n FROM b_cestas GROUP BY 1),
b_regras AS (
  SELECT a.product_id AS reference, b.product_id AS item, (SELECT count(DISTINCT order_id) FROM b_cestas) AS pedidos,
         any_value(x.n) AS pedidos_referencia, any_value(y.n) AS pedidos_item, count(*) AS pedidos_ambos
  FROM b_cestas a JOIN b_cestas b ON b.order_id = a.order_id AND b.product_id <> a.product_id
  JOIN b_n x ON x.product_id = a.product_id JOIN b_n y ON y.product_id = b.product_id
  WHERE a.product_id IN (SELECT id FROM r_products WHERE name IN {_NAMES}) GROUP BY 1, 2 HAVING count(*) >= {MIN_ORDERS}),
b_medidas AS (
  SELECT *, CAST(pedidos_ambos AS DOUBLE) / pedidos AS suporte, CAST(pedidos_ambos AS DOUBLE) / pedidos_referencia AS confianca,
         CAST(pedidos_ambos AS DOUBLE) * pedidos / (CAST(pedidos_referencia AS DOUBLE) * pedidos_item) AS lift FROM b_regras)""".strip()


def _references(c: Context) -> DataFrame:
    return c.raw["products"].filter(F.col("name").isin(*_NAMES)).select(F.col("id").alias("item"))


@query("basket_rules_top", _sql(
    "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY reference ORDER BY lift DESC, pedidos_ambos DESC, item) AS INTEGER) AS posicao "
    f"FROM b_medidas) WHERE posicao <= {TOP_RULES}", _RULE_CTES))
def basket_rules_top(c: Context):
    return recommend.top_rules(recommend.basket_rules(c.lines, _references(c), MIN_ORDERS), TOP_RULES)


@query("basket_rules_totals", _sql(
    "SELECT count(*) AS regras, count(DISTINCT reference) AS referencias, CAST(sum(pedidos_ambos) AS BIGINT) AS pedidos_ambos, max(lift) AS maior_lift, "
    "min(confianca) AS menor_confianca FROM b_medidas", _RULE_CTES))
def basket_rules_totals(c: Context):
    rules = recommend.basket_rules(c.lines, _references(c), MIN_ORDERS)
    return rules.agg(
        F.count(F.lit(1)).alias("regras"), F.count_distinct("reference").alias("referencias"), F.sum("pedidos_ambos").alias("pedidos_ambos"),
        F.max("lift").alias("maior_lift"), F.min("confianca").alias("menor_confianca"))


TOP_ITEMS = 5


def _hits_sql(listed: str) -> str:
    """Held-out items among the first new ones of a list (customer_id, product_id, position)."""
    return (
        f"(SELECT count(*) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY position) AS n FROM ({listed}) l "
        "WHERE NOT EXISTS (SELECT 1 FROM p_pares h WHERE h.customer_id = l.customer_id AND h.product_id = l.product_id)) t "
        f"JOIN p_retidos r ON r.customer_id = t.customer_id AND r.product_id = t.product_id WHERE n <= {TOP_ITEMS})")


_MODEL_HITS = _hits_sql("SELECT j.customer_id, s.product_id, s.position FROM p_julgados j JOIN p_listas s ON s.reference = j.reference")
_POPULAR_HITS = _hits_sql("SELECT j.customer_id, s.product_id, s.position FROM p_julgados j CROSS JOIN p_populares s")


@query("precision_at_k", _sql(
    f"SELECT {TOP_ITEMS} AS k, c AS clientes, s AS sem_historico, c - s - j AS sem_referencia, j AS julgados, m AS acertos_modelo, p AS acertos_popularidade, "
    f"CAST(m AS DOUBLE) / nullif(j * {TOP_ITEMS}, 0) AS precisao_modelo, CAST(p AS DOUBLE) / nullif(j * {TOP_ITEMS}, 0) AS precisao_popularidade "
    "FROM (SELECT (SELECT count(*) FROM p_ultimos) AS c, (SELECT count(*) FROM p_ultimos WHERE pedidos = 1) AS s, (SELECT count(*) FROM p_julgados) AS j, "
    f"{_MODEL_HITS} AS m, {_POPULAR_HITS} AS p)", f"""
p_ultimos AS (SELECT customer_id, max(row(data_pedido, order_id))[2] AS held, count(DISTINCT order_id) AS pedidos FROM m_items GROUP BY 1),
p_linhas AS (SELECT i.*, i.order_id = u.held AS retido FROM m_items i JOIN p_ultimos u ON u.customer_id = i.customer_id),
p_retidos AS (SELECT DISTINCT customer_id, product_id FROM p_linhas WHERE retido),
p_pares AS (SELECT DISTINCT customer_id, product_id FROM p_linhas WHERE NOT retido),
p_pop AS (SELECT product_id, count(*) AS n FROM p_pares GROUP BY 1),
p_populares AS (SELECT product_id, row_number() OVER (ORDER BY n DESC, product_id) AS position FROM p_pop),
p_refs AS (SELECT id FROM r_products WHERE name IN {_NAMES}),
p_julgados AS (
  SELECT customer_id, product_id AS reference FROM (SELECT customer_id, product_id, row_number() OVER (PARTITION BY customer_id ORDER BY max(data_pedido) DESC, product_id) AS p
  FROM p_linhas WHERE NOT retido AND product_id IN (SELECT id FROM p_refs) GROUP BY 1, 2) WHERE p = 1),
p_listas AS (
  SELECT reference, product_id, row_number() OVER (PARTITION BY reference ORDER BY s DESC, product_id) AS position FROM (
    SELECT a.product_id AS reference, b.product_id, count(*) / sqrt(CAST(any_value(x.n) AS DOUBLE) * any_value(y.n)) AS s
    FROM p_pares a JOIN p_pares b ON b.customer_id = a.customer_id AND b.product_id <> a.product_id
    JOIN p_pop x ON x.product_id = a.product_id JOIN p_pop y ON y.product_id = b.product_id
    WHERE a.product_id IN (SELECT id FROM p_refs) GROUP BY 1, 2))""".strip()))
def precision_at_k(c: Context):
    return recommend.precision_at_k(c.unified, _references(c), TOP_ITEMS)


# Customers of whom some share a tax id: the test data has one each.
_CLIENT_COLUMNS = ("legal_name", "trade_name", "email", "person_type")


def customers_sharing_tax_ids(customers: DataFrame) -> DataFrame:
    """Every tenth customer has its neighbour's tax id, with punctuation; some have none, or junk; junk values are NULL."""
    key, before = F.col("id"), F.lpad((F.col("id") - 1).cast("string"), 11, "0")
    dotted = F.concat(F.substring(before, 1, 3), F.lit("."), F.substring(before, 4, 3), F.lit("."), F.substring(before, 7, 3), F.lit("-"), F.substring(before, 10, 2))
    tax = F.when(key % 19 == 7, "n/a").when(key % 17 == 5, None).when(key % 10 == 3, dotted).when(key % 50 == 21, "000.000.000-00").otherwise(F.col("tax_id"))
    cleaned = [vocabulary.null_if_junk(x).alias(x) for x in ("legal_name", "trade_name", "email")]
    return customers.select("id", tax.alias("tax_id"), *cleaned, "person_type", "created_at")


_TAX_CTES = f"""
u_clientes AS (
  SELECT id, CASE WHEN id = 0 OR id % 19 = 7 THEN NULL WHEN id % 17 = 5 THEN NULL WHEN id % 10 = 3 THEN lpad(CAST(id - 1 AS VARCHAR), 11, '0')
                  WHEN id % 50 = 21 THEN NULL ELSE tax_id END AS tax_key,
         {clean('legal_name')} AS legal_name, {clean('trade_name')} AS trade_name, {clean('email')} AS email, person_type, created_at FROM r_customers),
u_ordem AS (
  SELECT *, CASE WHEN tax_key IS NULL THEN 'id' || id ELSE tax_key END AS g,
         (legal_name IS NOT NULL)::INT + (trade_name IS NOT NULL)::INT + (email IS NOT NULL)::INT + (person_type IS NOT NULL)::INT AS known FROM u_clientes),
u_mapa AS (
  SELECT *, first_value(id) OVER w AS kept_id, count(*) OVER (PARTITION BY g) AS linhas FROM u_ordem WINDOW w AS (PARTITION BY g ORDER BY known DESC, created_at, id))""".strip()


def _clients(c: Context) -> DataFrame:
    return customers_sharing_tax_ids(c.raw["customers"])


def _crosswalk(c: Context) -> DataFrame:
    return survivorship.tax_id_crosswalk(_clients(c), _CLIENT_COLUMNS)


@query("tax_id_crosswalk", over_ctes("SELECT id, kept_id, tax_key, linhas FROM u_mapa", _TAX_CTES))
def tax_id_crosswalk(c: Context):
    return _crosswalk(c)


def _value_sql(column: str) -> str:
    first = f"first({column} ORDER BY known DESC, created_at, id) FILTER ({column} IS NOT NULL)"
    return f"{first} AS {column}"


def _from_sql(column: str) -> str:
    return f"coalesce((first(id ORDER BY known DESC, created_at, id) FILTER ({column} IS NOT NULL) <> kept_id)::INT, 0)"


@query("tax_id_survivors", over_ctes(
    f"SELECT kept_id AS id, {', '.join(map(_value_sql, _CLIENT_COLUMNS))}, count(*) AS linhas, {' + '.join(map(_from_sql, _CLIENT_COLUMNS))} AS preenchidas "
    "FROM u_mapa GROUP BY kept_id", _TAX_CTES))
def tax_id_survivors(c: Context):
    return survivorship.surviving_rows(_clients(c), _crosswalk(c), _CLIENT_COLUMNS)


@query("tax_id_follow_proof", over_ctes(
    "SELECT 'antes' AS quando, count(*) AS linhas, CAST(sum(total) AS DOUBLE) AS soma, count(DISTINCT customer_id) AS chaves FROM r_orders UNION ALL "
    "SELECT 'depois', count(*), CAST(sum(total) AS DOUBLE), count(DISTINCT kept_id) FROM r_orders o JOIN u_mapa u ON u.id = o.customer_id", _TAX_CTES))
def tax_id_follow_proof(c: Context):
    """Orders moved to the kept customers: as many rows, the same sum, fewer customers."""
    return survivorship.follow_proof(c.raw["orders"], _crosswalk(c), "customer_id", "total")


# Return reasons written in many ways: the test data has one way.
REASONS = {
    "defeito": ("com defeito", "produto defeituoso"), "arrependimento": ("desistência", "mudei de ideia"), "tamanho errado": ("não serviu", "tamanho incorreto"),
    "produto trocado": ("item errado", "veio outro produto"), "atraso na entrega": ("chegou atrasado", "demora"), "avaria no transporte": ("chegou quebrado", "avariado"),
}


def _spelled(reason: Column, other: Column, way: Column) -> Column:
    n = F.char_length(reason)
    return (
        F.when(way == 1, F.upper(reason)).when(way == 2, F.concat(F.lit("  "), F.replace(reason, F.lit(" "), F.lit("   ")), F.lit(".")))
        .when(way == 3, F.concat(F.substring(reason, 1, 1), F.substr(reason, F.lit(3), n))).when(way == 4, other)
        .when(way == 5, F.concat(F.lit("x"), F.substr(reason, F.lit(2), n))).when(way == 6, F.concat(F.substring(reason, 1, 2), F.substr(reason, F.lit(2), n)))
        .when(way == 7, F.concat(F.lit("outro motivo "), F.lit("qualquer"))).otherwise(reason))


def returns_with_reasons(returns: DataFrame) -> DataFrame:
    """Returns whose reasons are spelled in eight ways, some not at all."""
    key = F.col("id")
    at = lambda values, n: F.get(F.array(*map(F.lit, values)), n.cast("int"))
    which, way = key % 6, F.call_function("div", key, F.lit(6).cast("long")) % 8
    spelled = _spelled(at(list(REASONS), which), at([known[0] for known in REASONS.values()], which), way)
    return returns.withColumn("reason", F.when(key % 23 == 0, None).when(key % 23 == 1, " N/A ").otherwise(spelled))


def _texts(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_PLAIN = {name: [vocabulary._plain(x) for x in (name, *known)] for name, known in REASONS.items()}
_NEAR = ", ".join(f"('{name}', '{s}', {min(2, len(s) // 4)})" for name, known in _PLAIN.items() for s in known)
_REASON_CTES = f"""
v_returns AS (
  SELECT id, CASE WHEN id % 23 = 0 THEN NULL WHEN id % 23 = 1 THEN ' N/A ' ELSE CASE (id // 6) % 8
    WHEN 1 THEN upper(r) WHEN 2 THEN '  ' || replace(r, ' ', '   ') || '.' WHEN 3 THEN substr(r, 1, 1) || substr(r, 3) WHEN 4 THEN o
    WHEN 5 THEN 'x' || substr(r, 2) WHEN 6 THEN substr(r, 1, 2) || substr(r, 2) WHEN 7 THEN 'outro motivo qualquer' ELSE r END END AS reason
  FROM (SELECT id, ({_texts(REASONS)})[id % 6 + 1] AS r, ({_texts(k[0] for k in REASONS.values())})[id % 6 + 1] AS o FROM r_returns)),
v_valores AS (
  SELECT reason AS valor, count(*) AS linhas, nullif(trim(regexp_replace(strip_accents(lower({clean('reason')})), '[^a-z0-9]+', ' ', 'g')), '') AS p FROM v_returns GROUP BY reason),
v_formas(classe, forma, limite) AS (VALUES {_NEAR}),
v_perto AS (
  SELECT valor, min(d) AS d, list_distinct(list(classe) FILTER (d = least)) AS classes FROM (
    SELECT valor, classe, levenshtein(p, forma) AS d, min(levenshtein(p, forma)) OVER (PARTITION BY valor) AS least
    FROM v_valores, v_formas WHERE p IS NOT NULL AND levenshtein(p, forma) <= limite) GROUP BY valor),
v_classes AS (
  SELECT v.valor, v.linhas, e.classe AS exata, f.classe AS variante, n.d, n.classes, v.p FROM v_valores v
  LEFT JOIN (VALUES {', '.join(f"('{name}', '{known[0]}')" for name, known in _PLAIN.items())}) e(classe, forma) ON e.forma = v.p
  LEFT JOIN (VALUES {', '.join(f"('{name}', '{x}')" for name, known in _PLAIN.items() for x in known[1:])}) f(classe, forma) ON f.forma = v.p
  LEFT JOIN v_perto n ON n.valor = v.valor),
v_regras AS (
  SELECT valor, linhas, coalesce(exata, variante, CASE WHEN len(classes) = 1 THEN classes[1] END) AS classe,
         CASE WHEN p IS NULL THEN 'nulo' WHEN exata IS NOT NULL THEN 'exata' WHEN variante IS NOT NULL THEN 'variante' WHEN d IS NULL THEN 'sem_classe'
              WHEN len(classes) = 1 THEN 'distancia' ELSE 'ambigua' END AS regra,
         CASE WHEN exata IS NULL AND variante IS NULL THEN CAST(d AS INTEGER) END AS edicoes FROM v_classes)""".strip()


def _values(c: Context) -> DataFrame:
    return vocabulary.canonical_values(returns_with_reasons(c.raw["returns"]), "reason", REASONS)


@query("return_reasons_canonical", over_ctes("SELECT * FROM v_regras", _REASON_CTES))
def return_reasons_canonical(c: Context):
    return _values(c)


@query("return_reasons_by_class", over_ctes(
    "SELECT g.classe, count(*) AS devolucoes FROM v_returns r JOIN v_regras g ON g.valor IS NOT DISTINCT FROM r.reason GROUP BY 1", _REASON_CTES))
def return_reasons_by_class(c: Context):
    """Returns per class; those without one are counted, not dropped."""
    classed = vocabulary.with_class(returns_with_reasons(c.raw["returns"]), "reason", _values(c))
    return classed.groupBy("classe").agg(F.count(F.lit(1)).alias("devolucoes"))


# Attributes of variants as rows of name and value: the test data has columns.
ATTRIBUTES = {"peso": "double", "ativo": "boolean", "sku": "string", "lote": "bigint"}


def variant_attributes(variants: DataFrame) -> DataFrame:
    """Rows of variant, name, value and sequence, some repeated, contradictory, of the wrong type or of unknown name."""
    key = F.col("id")
    row = lambda when, name, value, n: F.when(when, F.struct(F.lit(name).alias("nome"), value.alias("valor"), F.lit(n).alias("seq")))
    weight = F.replace(F.col("weight_kg").cast("string"), F.lit("."), F.lit(","))
    rows = [
        row(F.lit(True), "Peso ", weight, 1), row(key % 9 == 0, "peso", F.lit("9.5"), 2), row(key % 13 == 0, "peso", F.lit("pesado"), 3),
        row(key % 3 != 0, "ATIVO", F.when(F.col("is_active"), "Sim").otherwise("não"), 1), row(key % 5 == 0, "sku", F.col("sku"), 1),
        row(key % 10 == 0, "sku", F.col("sku"), 1), row(key % 4 == 0, "lote", (key * 3).cast("string"), 1), row(key % 7 == 0, "garantia", F.lit("12 meses"), 1),
        row(key % 11 == 0, None, F.lit("?"), 1)]
    each = F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull()))
    return variants.select(key.alias("product_variant_id"), each.alias("_a")).select("product_variant_id", "_a.*")


@query("variant_attributes_typed", over_ctes(
    "SELECT id AS product_variant_id, CASE WHEN id % 9 = 0 THEN 9.5 ELSE CAST(weight_kg AS DOUBLE) END AS peso, CASE WHEN id % 3 <> 0 THEN is_active END AS ativo, "
    "CASE WHEN id % 5 = 0 THEN sku END AS sku, CASE WHEN id % 4 = 0 THEN id * 3 END AS lote, CASE WHEN id % 9 = 0 THEN 1 ELSE 0 END AS conflitos, "
    "CAST(CASE WHEN id % 13 = 0 THEN 1 ELSE 0 END AS BIGINT) AS invalidos, CAST((id % 7 = 0)::INT + (id % 11 = 0)::INT AS BIGINT) AS desconhecidos FROM r_variants"))
def variant_attributes_typed(c: Context):
    return vocabulary.unpack_attributes(variant_attributes(c.raw["product_variants"]), ATTRIBUTES, "product_variant_id", "nome", "valor", "seq")


@query("variant_attributes_undeclared", over_ctes(
    "SELECT nome, count(*) AS linhas, min(valor) AS exemplo FROM (SELECT 'garantia' AS nome, '12 meses' AS valor FROM r_variants WHERE id % 7 = 0 "
    "UNION ALL SELECT NULL, '?' FROM r_variants WHERE id % 11 = 0) GROUP BY nome"))
def variant_attributes_undeclared(c: Context):
    return vocabulary.undeclared_names(variant_attributes(c.raw["product_variants"]), ATTRIBUTES, "nome", "valor")


def _mix_sql(by: str) -> str:
    return over_ctes(
        f"SELECT {by}, count(*) AS payments, CAST(sum(valor) AS DOUBLE) AS payment_value, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 9) AS share_payments, "
        f"round(CAST(sum(valor) AS DOUBLE) / CAST(sum(sum(valor)) OVER () AS DOUBLE), 9) AS share_payment_value FROM g_fct_pagamento GROUP BY {by}")


def _mix(c: Context, *by: str) -> DataFrame:
    return _rounded(metrics.mix(c.star, ["payments", "payment_value"], [f"fct_pagamento.{b}" for b in by]), "share_payments", "share_payment_value")


@query("payment_mix_by_method", _mix_sql("metodo"))
def payment_mix_by_method(c: Context):
    return _mix(c, "metodo")


@query("payment_mix_by_installments", _mix_sql("metodo, parcelas"))
def payment_mix_by_installments(c: Context):
    """Shares of method and number of instalments; the fact stays isolated from orders."""
    return _mix(c, "metodo", "parcelas")
