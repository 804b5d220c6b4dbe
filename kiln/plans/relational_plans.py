"""Projections, predicates, joins, set operations, sorting (D, J, U, O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import relational as rel
from kiln.operators.indexing import zip_with_index, zip_with_unique_id
from kiln.operators.joins import join_small
from kiln.plans.registry import query
from kiln.sources.tables import table


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# ----------------------------------------------------------------- D: columns

@query("d1_select_expr", ids=("D1",), sql="""
SELECT l_orderkey, l_linenumber, l_quantity * 2 AS q2, 1 AS one,
       round(l_extendedprice * (1 - l_discount), 4) AS disc_price, l_quantity * 2 + 1 AS q2p1
FROM lineitem""")
def d1_select_expr(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    s = li.select(F.col("l_orderkey"), F.column("l_linenumber"), (li.l_quantity * 2).alias("q2"),
                  F.lit(1).alias("one"),
                  F.expr("round(l_extendedprice * (1 - l_discount), 4)").alias("disc_price"))
    return s.selectExpr("l_orderkey", "l_linenumber", "q2", "one", "disc_price", "q2 + one AS q2p1")


@query("d2_with_column_rename_drop", ids=("D2",), sql="""
SELECT o_orderkey, o_custkey, o_orderstatus AS status, round(o_totalprice * 1.1, 4) AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders""")
def d2_with_column_rename_drop(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return (o.withColumn("o_totalprice", F.round(o.o_totalprice * 1.1, 4))
             .withColumn("order_year", F.year("o_orderdate"))
             .withColumnRenamed("o_orderstatus", "status")
             .drop("o_orderdate", "o_orderpriority"))


@query("d3_filter_where_getitem", ids=("D3",), sql="""
SELECT l_orderkey, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 20 AND l_discount < 0.05 AND l_returnflag = 'R'""")
def d3_filter_where_getitem(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    f = li.filter(F.col("l_quantity") > 20).where("l_discount < 0.05")
    f = f[f["l_returnflag"] == "R"]
    return f[["l_orderkey", "l_quantity", "l_discount"]]


@query("d4_arithmetic", ids=("D4",), sql="""
SELECT l_orderkey, l_linenumber, -l_quantity AS neg_q, l_quantity + l_tax AS add_,
       l_extendedprice - 1 AS sub_, round(l_quantity * l_discount, 6) AS mul_,
       round(l_extendedprice / l_quantity, 6) AS div_, round(l_extendedprice % 7, 6) AS mod_,
       round(l_quantity / nullif(l_discount, 0), 6) AS safe_div, 1 - l_discount AS rsub,
       round(100 / l_quantity, 6) AS rdiv, CAST(l_linenumber / 2 AS DOUBLE) AS int_div
FROM lineitem""")
def d4_arithmetic(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    return li.select(
        "l_orderkey", "l_linenumber", (-q).alias("neg_q"), (q + F.col("l_tax")).alias("add_"),
        (F.col("l_extendedprice") - 1).alias("sub_"), F.round(q * F.col("l_discount"), 6).alias("mul_"),
        F.round(F.col("l_extendedprice") / q, 6).alias("div_"),
        F.round(F.col("l_extendedprice") % 7, 6).alias("mod_"),
        F.round(F.try_divide(q, F.col("l_discount")), 6).alias("safe_div"),
        (1 - F.col("l_discount")).alias("rsub"), F.round(100 / q, 6).alias("rdiv"),
        (F.col("l_linenumber") / 2).alias("int_div"))


@query("d5_comparison_logic", ids=("D5",), sql="""
WITH x AS (SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 1) AS q, l_discount, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, q > 3 AS gt, q = 4 AS eq, q <> 2 AS ne, q <= 2 AS le, q >= 5 AS ge, q < 3 AS lt,
       (q > 3) AND (l_discount > 0.05) AS and_, (q > 3) OR (l_tax > 0.05) AS or_, NOT (q > 3) AS not_,
       q IS NOT DISTINCT FROM 2 AS eq_null_safe
FROM x""")
def d5_comparison_logic(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    q = F.nullif(F.col("l_linenumber"), F.lit(1))
    return li.select("l_orderkey", "l_linenumber", (q > 3).alias("gt"), (q == 4).alias("eq"),
                     (q != 2).alias("ne"), (q <= 2).alias("le"), (q >= 5).alias("ge"), (q < 3).alias("lt"),
                     ((q > 3) & (F.col("l_discount") > 0.05)).alias("and_"),
                     ((q > 3) | (F.col("l_tax") > 0.05)).alias("or_"), (~(q > 3)).alias("not_"),
                     q.eqNullSafe(2).alias("eq_null_safe"))


@query("d6_bitwise", ids=("D6",), sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_orderkey & l_partkey AS b_and, l_orderkey | l_partkey AS b_or,
       xor(l_orderkey, l_partkey) AS b_xor, ~l_suppkey AS b_not, l_orderkey << 2 AS shl,
       l_partkey >> 1 AS shr, l_suppkey >> 3 AS shru
FROM lineitem""")
def d6_bitwise(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", o.bitwiseAND(p).alias("b_and"),
                     o.bitwiseOR(p).alias("b_or"), o.bitwiseXOR(p).alias("b_xor"),
                     F.bitwise_not(s).alias("b_not"), F.shiftleft(o, 2).alias("shl"),
                     F.shiftright(p, 1).alias("shr"), F.shiftrightunsigned(s, 3).alias("shru"))


@query("d7_string_predicates", ids=("D7",), sql="""
SELECT p_partkey, p_name LIKE '%a%e%' AS like_, regexp_matches(p_name, '^[a-m]') AS rlike_,
       starts_with(p_type, 'S') AS starts_, ends_with(p_type, 'L') AS ends_,
       contains(p_name, 'or') AS contains_, substr(p_name, 2, 3) AS sub_
FROM part""")
def d7_string_predicates(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    n = F.col("p_name")
    return p.select("p_partkey", n.like("%a%e%").alias("like_"), n.rlike("^[a-m]").alias("rlike_"),
                    F.col("p_type").startswith("S").alias("starts_"), F.col("p_type").endswith("L").alias("ends_"),
                    n.contains("or").alias("contains_"), n.substr(2, 3).alias("sub_"))


@query("d8_null_membership_between", ids=("D8",), sql="""
WITH x AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, c_nationkey, c_acctbal FROM customer)
SELECT c_custkey, seg IS NULL AS seg_null, seg IS NOT NULL AS seg_present, c_nationkey IN (1, 2, 3) AS in_set,
       seg IN ('MACHINERY', 'HOUSEHOLD') AS seg_in, c_acctbal BETWEEN 0 AND 1000 AS bal_between
FROM x""")
def d8_null_membership_between(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey", seg.isNull().alias("seg_null"), seg.isNotNull().alias("seg_present"),
                    F.col("c_nationkey").isin(1, 2, 3).alias("in_set"),
                    seg.isin(["MACHINERY", "HOUSEHOLD"]).alias("seg_in"),
                    F.col("c_acctbal").between(0, 1000).alias("bal_between"))


@query("d9_cast", ids=("D9",), sql="""
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_str, CAST(trunc(p_retailprice) AS INTEGER) AS price_int,
       CAST(p_size AS DOUBLE) AS size_dbl, TRY_CAST(split_part(p_name, ' ', 1) AS INTEGER) AS bad_int,
       CAST(p_retailprice > 1000 AS INTEGER) AS flag_int, TRY_CAST(CAST(p_size AS VARCHAR) AS BIGINT) AS round_trip
FROM part""")
def d9_cast(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", F.col("p_size").cast("string").alias("size_str"),
                    F.col("p_retailprice").cast("int").alias("price_int"),
                    F.col("p_size").cast("double").alias("size_dbl"),
                    F.split("p_name", " ").getItem(0).try_cast("int").alias("bad_int"),
                    (F.col("p_retailprice") > 1000).cast("int").alias("flag_int"),
                    F.col("p_size").cast("string").try_cast("bigint").alias("round_trip"))


@query("d10_case_coalesce_greatest", ids=("D10",), sql="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
       CASE WHEN l_discount > 0.05 THEN l_discount END AS big_discount,
       coalesce(CASE WHEN l_discount > 0.05 THEN l_discount END, l_tax, 0.0) AS first_present,
       greatest(l_discount, l_tax) AS greatest_, least(l_discount, l_tax) AS least_
FROM lineitem""")
def d10_case_coalesce_greatest(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    big = F.when(F.col("l_discount") > 0.05, F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 30, "medium")
                      .otherwise("large").alias("size_class"),
                     big.alias("big_discount"),
                     F.coalesce(big, F.col("l_tax"), F.lit(0.0)).alias("first_present"),
                     F.greatest("l_discount", "l_tax").alias("greatest_"),
                     F.least("l_discount", "l_tax").alias("least_"))


@query("d11_get_item_field", ids=("D11",), sql="""
SELECT p_partkey, string_split(p_type, ' ')[1] AS first_word, string_split(p_type, ' ')[5] AS fifth_word,
       {'size': p_size, 'brand': p_brand}.brand AS brand_field,
       len(string_split(p_type, ' ')) AS n_words
FROM part""")
def d11_get_item_field(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    words = F.split("p_type", " ")
    st = F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    return p.select("p_partkey", words.getItem(0).alias("first_word"),
                    F.try_element_at(words, F.lit(5)).alias("fifth_word"),
                    st.getField("brand").alias("brand_field"), F.size(words).cast("bigint").alias("n_words"))


_NULLY_CUSTOMER = """WITH x AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS nat FROM customer)"""


def _nully_customer(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
                    F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
                    F.when(F.col("c_nationkey") != 0, F.col("c_nationkey")).alias("nat"))


@query("d12_dropna", ids=("D12",), sql=_NULLY_CUSTOMER + """
SELECT 'any' AS how, count(*) AS n FROM x WHERE seg IS NOT NULL AND bal IS NOT NULL AND nat IS NOT NULL
UNION ALL SELECT 'all', count(*) FROM x WHERE seg IS NOT NULL OR bal IS NOT NULL OR nat IS NOT NULL
UNION ALL SELECT 'thresh2', count(*) FROM x
  WHERE (CASE WHEN seg IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN bal IS NOT NULL THEN 1 ELSE 0 END)
      + (CASE WHEN nat IS NOT NULL THEN 1 ELSE 0 END) >= 2
UNION ALL SELECT 'subset', count(*) FROM x WHERE seg IS NOT NULL""")
def d12_dropna(spark, sf_dir):
    """Rows that dropna keeps for each ``how``, counted in one scan: each
    rule is a condition on the number of values a row has."""
    x = _nully_customer(spark, sf_dir).drop("c_custkey")
    n = sum((F.col(c).isNotNull().cast("int") for c in x.columns), F.lit(0))
    rules = {"any": n == len(x.columns), "all": n > 0, "thresh2": n >= 2, "subset": F.col("seg").isNotNull()}
    wide = x.agg(*(F.count_if(rule).alias(f"n_{how}") for how, rule in rules.items()))
    return wide.selectExpr(f"stack({len(rules)}, {', '.join(f"'{how}', n_{how}" for how in rules)}) AS (how, n)")


@query("d12_fillna", ids=("D12",), sql=_NULLY_CUSTOMER + """
SELECT c_custkey, coalesce(seg, 'UNKNOWN') AS seg, coalesce(bal, 0.0) AS bal, coalesce(nat, -1) AS nat FROM x""")
def d12_fillna(spark, sf_dir):
    x = _nully_customer(spark, sf_dir)
    return x.fillna({"seg": "UNKNOWN", "bal": 0.0}).na.fill(-1, subset=["nat"])


@query("d12_replace", ids=("D12",), sql=_NULLY_CUSTOMER + """
SELECT c_custkey, CASE WHEN seg = 'MACHINERY' THEN 'MACH' WHEN seg = 'HOUSEHOLD' THEN 'HOME' ELSE seg END AS seg,
       bal, nat FROM x""")
def d12_replace(spark, sf_dir):
    x = _nully_customer(spark, sf_dir)
    return x.replace({"MACHINERY": "MACH", "HOUSEHOLD": "HOME"}, subset=["seg"])


@query("d14_ids_and_random_columns", ids=("D14",), sql="""
SELECT count(*) AS n, count(*) AS n_ids, true AS ids_name_partitions, true AS uniform, true AS normal FROM orders""")
def d14_ids_and_random_columns(spark, sf_dir):
    """Ids are unique and carry the partition in their upper bits; the draws
    have the mean and spread of their distributions."""
    o = _t(spark, sf_dir, "orders").select(
        F.monotonically_increasing_id().alias("mono_id"), F.spark_partition_id().alias("pid"), F.rand(7).alias("u"), F.randn(7).alias("z"))
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("mono_id").alias("n_ids"),
                 F.every(F.shiftright("mono_id", 33) == F.col("pid")).alias("ids_name_partitions"),
                 (F.every(F.col("u").between(0, 1)) & F.avg("u").between(0.4, 0.6)).alias("uniform"),
                 (F.avg("z").between(-0.2, 0.2) & F.stddev("z").between(0.85, 1.15)).alias("normal"))


_SAMPLE_SQL = "SELECT true AS from_the_table, {distinct} AS no_repeats, true AS size_in_bounds"


def _sample_check(orders, sample, share):
    """One row: whether the sample's keys are the table's, none twice, and its
    size within six deviations of ``share`` of the table."""
    n = orders.count()
    spread = 6 * (n * share) ** 0.5 + 1
    known = sample.join(orders.select("o_orderkey", F.lit(True).alias("known")), "o_orderkey", "left")
    return known.agg(F.every(F.col("known").isNotNull()).alias("from_the_table"),
                     (F.count(F.lit(1)) == F.count_distinct("o_orderkey")).alias("no_repeats"),
                     F.count(F.lit(1)).between(n * share - spread, n * share + spread).alias("size_in_bounds"))


@query("d15_bernoulli_sample", ids=("D15",), sql=_SAMPLE_SQL.format(distinct="true"))
def d15_bernoulli_sample(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return _sample_check(o, o.sample(withReplacement=False, fraction=0.1, seed=3).select("o_orderkey"), 0.1)


@query("d15_sample_with_replacement", ids=("D15",), sql=_SAMPLE_SQL.format(distinct="false"))
def d15_sample_with_replacement(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return _sample_check(o, o.sample(withReplacement=True, fraction=0.5, seed=3).select("o_orderkey"), 0.5)


@query("d15_stratified_sample", ids=("D15",), sql="""
SELECT o_orderstatus, true AS size_in_bounds FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""")
def d15_stratified_sample(spark, sf_dir):
    """Each listed stratum at its own fraction, others not at all."""
    fractions = {"F": 0.1, "O": 0.2}
    o = _t(spark, sf_dir, "orders")
    whole = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    got = o.sampleBy("o_orderstatus", fractions, seed=5).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("m"))
    share = F.when(F.col("o_orderstatus") == "F", fractions["F"]).when(F.col("o_orderstatus") == "O", fractions["O"])
    spread = 6 * F.sqrt(F.col("n") * share) + 1
    return got.join(whole, "o_orderstatus").select("o_orderstatus", (F.abs(F.col("m") - F.col("n") * share) <= spread).alias("size_in_bounds"))


@query("d15_random_split", ids=("D15",), sql="""
SELECT o_orderkey, 1 AS splits FROM orders""")
def d15_random_split(spark, sf_dir):
    """The splits are a partition of the table: every row is in one."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    a, b, c = o.randomSplit([0.6, 0.3, 0.1], seed=11)
    return a.unionByName(b).unionByName(c).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("splits"))


@query("d15_exact_size_sample", ids=("D15",), sql="""
SELECT 100 AS n, 100 AS n_keys, true AS from_the_table""")
def d15_exact_size_sample(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    s = rel.take_sample(o, 100, seed=13).join(o.withColumn("known", F.lit(True)), "o_orderkey", "left")
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys"),
                 F.every(F.col("known").isNotNull()).alias("from_the_table"))


@query("d15_key_systematic_sample", ids=("D15",), sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 3""")
def d15_key_systematic_sample(spark, sf_dir):
    """Deterministic sample by key residue: repeatable, and checkable."""
    o = _t(spark, sf_dir, "orders")
    return rel.key_sample(o, "o_orderkey", 10, 3).select("o_orderkey", "o_totalprice")


@query("d16_partition_sizes", ids=("D16",), sql="""
SELECT 'hash6' AS kind, count(*) AS n, true AS in_bound, true AS keys_together FROM lineitem
UNION ALL SELECT 'coalesce2', count(*), true, true FROM lineitem""")
def d16_partition_sizes(spark, sf_dir):
    """Rows and number of partitions after repartition by key and coalesce;
    repartition puts all rows of a key into one."""
    li = _t(spark, sf_dir, "lineitem")
    out = None
    for kind, parts, df in (("hash6", 6, li.repartition(6, "l_orderkey")), ("coalesce2", 2, li.coalesce(2))):
        keys = df.groupBy(F.spark_partition_id().alias("pid"), "l_orderkey").agg(F.count(F.lit(1)).alias("n"))
        together = F.lit(True) if kind != "hash6" else F.count(F.lit(1)) == F.count_distinct("l_orderkey")
        row = keys.agg(F.lit(kind).alias("kind"), F.sum("n").alias("n"), (F.count_distinct("pid") <= parts).alias("in_bound"),
                       together.alias("keys_together"))
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ J: joins

@query("j1_inner_join_on_name", ids=("J1",), sql="""
SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def j1_inner_join_on_name(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return li.join(o, "l_orderkey", "inner").select("l_orderkey", "l_linenumber", "l_quantity",
                                                    "o_custkey", "o_orderstatus")


@query("j2_left_outer_join", ids=("J2",), sql="""
SELECT c_custkey, count(o_orderkey) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def j2_left_outer_join(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"),
                                      F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("total"))


@query("j2_right_and_full_outer_join", ids=("J2",), sql="""
SELECT 'right' AS kind, o_orderkey, c_custkey FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT 'full', s_suppkey, c_custkey FROM supplier FULL OUTER JOIN customer ON s_nationkey = c_nationkey AND s_suppkey = c_custkey""")
def j2_right_and_full_outer_join(spark, sf_dir):
    """Customers without orders stay in the right join; suppliers and
    customers that don't match stay on both sides of the full one."""
    o, c, s = (_t(spark, sf_dir, name) for name in ("orders", "customer", "supplier"))
    r = o.join(c, o.o_custkey == c.c_custkey, "right").select(F.lit("right").alias("kind"), "o_orderkey", "c_custkey")
    same = (s.s_nationkey == c.c_nationkey) & (s.s_suppkey == c.c_custkey)
    f = s.join(c, same, "full").select(F.lit("full").alias("kind"), F.col("s_suppkey").alias("o_orderkey"), "c_custkey")
    return r.unionByName(f)


@query("j3_left_semi_join", ids=("J3",), sql="""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def j3_left_semi_join(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("j4_left_anti_join", ids=("J4",), sql="""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def j4_left_anti_join(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("j6_theta_join", ids=("J6",), sql="""
SELECT l_orderkey, l_linenumber, CAST(datediff('day', o_orderdate, l_shipdate) AS INTEGER) AS ship_lag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  AND l_shipdate > o_orderdate + INTERVAL 60 DAY AND l_quantity > 10""")
def j6_theta_join(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    conds = [li.l_orderkey == o.o_orderkey,
             li.l_shipdate > o.o_orderdate + F.expr("INTERVAL 60 DAYS"),
             li.l_quantity > 10]
    j = li.join(o, conds, "inner")
    return j.select("l_orderkey", "l_linenumber",
                    F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("ship_lag"))


@query("j6_band_join", ids=("J6",), sql="""
SELECT o1.o_orderkey AS k1, o2.o_orderkey AS k2
FROM orders o1 JOIN orders o2 ON o1.o_custkey = o2.o_custkey AND o1.o_orderkey < o2.o_orderkey
 AND abs(o1.o_totalprice - o2.o_totalprice) <= 500""")
def j6_band_join(spark, sf_dir):
    """Orders of the same customer whose totals lie within 500 of each other
    (equi key + band; the band is bucketed so no key pair is enumerated
    beyond neighbouring bands)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rel.band_self_join(o, "o_custkey", "o_orderkey", "o_totalprice", 500.0)


@query("j7_cogroup_aggregates", ids=("J7",), sql="""
WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders, round(sum(o_totalprice), 2) AS order_total FROM orders GROUP BY 1),
     b AS (SELECT c_custkey AS k, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(n_orders, 0) AS n_orders, order_total,
       coalesce(n_customers, 0) AS n_customers, balance
FROM a FULL OUTER JOIN b ON a.k = b.k""")
def j7_cogroup_aggregates(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return rel.cogroup_aggregate(o, c, "k", "v", ("n_orders", "order_total"), ("n_customers", "balance"))


@query("j8_lookup_key", ids=("J8",), sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = (SELECT min(c_custkey) FROM customer)""")
def j8_lookup_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    k = _t(spark, sf_dir, "customer").agg(F.min("c_custkey")).first()[0]
    return rel.lookup(o, "o_custkey", k).select("o_orderkey", "o_totalprice")


@query("j9_zip_with_index", ids=("J9",), sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders""")
def j9_zip_with_index(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    return zip_with_index(o, ["o_orderkey"], "idx")


@query("j9_zip_by_position", ids=("J9",), sql="""
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
     b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer)
SELECT a.idx, o_orderkey, c_custkey FROM a JOIN b ON a.idx = b.idx""")
def j9_zip_by_position(spark, sf_dir):
    a = zip_with_index(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "idx")
    b = zip_with_index(_t(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "idx")
    return a.join(b, "idx").select("idx", "o_orderkey", "c_custkey")


@query("j9_zip_with_unique_id", ids=("J9",), sql="""
SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys, count(*) AS n_ids FROM orders""")
def j9_zip_with_unique_id(spark, sf_dir):
    ids = zip_with_unique_id(_t(spark, sf_dir, "orders").select("o_orderkey"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys"), F.count_distinct("uid").alias("n_ids"))


@query("j10_broadcast_dimension_join", ids=("J10",), sql="""
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def j10_broadcast_dimension_join(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    # nation/region are measured before they are broadcast (join_small)
    nr = join_small(n, r.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"])
    j = join_small(c.withColumnRenamed("c_nationkey", "n_nationkey"), nr, ["n_nationkey"])
    return j.select("c_custkey", "n_name", "r_name")


# ------------------------------------------------------------- U: set ops

@query("u1_union_all", ids=("U1",), sql="""
SELECT k, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer) GROUP BY k""")
def u1_union_all(spark, sf_dir):
    a = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return a.union(b).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("u2_intersect", ids=("U2",), sql="""
SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer""")
def u2_intersect(spark, sf_dir):
    a = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return a.intersect(b)


@query("u3_except_distinct", ids=("U3",), sql="""
SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders""")
def u3_except_distinct(spark, sf_dir):
    a = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    b = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return a.subtract(b)


@query("u4_subtract_keep_duplicates", ids=("U4",), sql="""
SELECT o_custkey AS k FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey IS NOT DISTINCT FROM o.o_custkey)""")
def u4_subtract_keep_duplicates(spark, sf_dir):
    a = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    return rel.subtract_keep_duplicates(a, b)


@query("u5_distinct", ids=("U5",), sql="""
SELECT DISTINCT o_custkey, o_orderstatus FROM orders""")
def u5_distinct(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("u5_drop_duplicates_subset", ids=("U5",), sql="""
SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""")
def u5_drop_duplicates_subset(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return rel.drop_duplicates_first(o, ["o_custkey"], ["o_orderkey"])


# ------------------------------------------------------------ O: ordering

@query("o1_global_sort_position", ids=("O1",), sql="""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) - 1 AS pos FROM orders""")
def o1_global_sort_position(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return zip_with_index(o.withColumn("_neg", -F.col("o_totalprice")), ["_neg", "o_orderkey"], "pos").drop("_neg")


@query("o2_limit_first_n", ids=("O2",), sql="""
SELECT o_orderkey, o_orderdate::VARCHAR AS o_orderdate FROM orders ORDER BY o_orderkey LIMIT 10""")
def o2_limit_first_n(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.orderBy("o_orderkey").limit(10).select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))


@query("o3_top_k", ids=("O3",), sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def o3_top_k(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(20).select("o_orderkey", "o_totalprice")


@query("o4_repartition_sort_within", ids=("O4",), sql="""
SELECT count(*) AS n, true AS keys_together, true AS sorted_within FROM lineitem""")
def o4_repartition_sort_within(spark, sf_dir):
    """Rows of a key share a partition, and each partition is in order: no
    row is less than the one before it."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    r = li.repartition(4, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber").select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("at"))
    pos = F.struct("l_orderkey", "l_linenumber")
    before = r.select((F.col("at") + 1).alias("at"), pos.alias("before"))
    in_order = r.join(before, "at", "left").select("l_orderkey", "pid", (F.col("before").isNull() | (F.col("before") <= pos)).alias("ok"))
    keys = in_order.groupBy("l_orderkey").agg(F.count_distinct("pid").alias("pids"), F.count(F.lit(1)).alias("n"), F.every("ok").alias("ok"))
    return keys.agg(F.sum("n").alias("n"), F.every(F.col("pids") == 1).alias("keys_together"), F.every("ok").alias("sorted_within"))
