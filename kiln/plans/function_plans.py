"""Scalar functions (F1-F15).  Functions without a DuckDB twin (soundex,
crc32, conv, initcap, format_number, substring_index, next_day,
months_between, time-zone shifts, query-time constants) are in separate
rows-only queries; tests/test_functions.py pins their golden values."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.plans.registry import query
from kiln.sources.tables import table
from kiln.streaming.runner import utc_session

R = 10  # digits kept for transcendental results


def _li(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("f1_trigonometry", ids=("F1",), sql=f"""
SELECT l_orderkey, l_linenumber, round(sin(l_discount), {R}) AS sin_, round(cos(l_discount), {R}) AS cos_,
  round(tan(l_discount), {R}) AS tan_, round(asin(l_discount), {R}) AS asin_, round(acos(l_discount), {R}) AS acos_,
  round(atan(l_discount), {R}) AS atan_, round(atan2(l_discount, l_tax + 0.01), {R}) AS atan2_,
  round(sinh(l_discount), {R}) AS sinh_, round(cosh(l_discount), {R}) AS cosh_, round(tanh(l_discount), {R}) AS tanh_,
  round(degrees(l_discount), {R}) AS deg_, round(radians(l_quantity), {R}) AS rad_
FROM lineitem""")
def f1_trigonometry(spark, sf_dir):
    x, y = F.col("l_discount"), F.col("l_tax") + 0.01
    return _li(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.round(F.sin(x), R).alias("sin_"), F.round(F.cos(x), R).alias("cos_"),
        F.round(F.tan(x), R).alias("tan_"), F.round(F.asin(x), R).alias("asin_"), F.round(F.acos(x), R).alias("acos_"),
        F.round(F.atan(x), R).alias("atan_"), F.round(F.atan2(x, y), R).alias("atan2_"),
        F.round(F.sinh(x), R).alias("sinh_"), F.round(F.cosh(x), R).alias("cosh_"), F.round(F.tanh(x), R).alias("tanh_"),
        F.round(F.degrees(x), R).alias("deg_"), F.round(F.radians("l_quantity"), R).alias("rad_"))


@query("f2_exp_log_pow", ids=("F2",), sql=f"""
SELECT l_orderkey, l_linenumber, round(exp(l_discount), {R}) AS exp_, round(exp(l_discount) - 1, {R}) AS expm1_,
  round(ln(l_quantity), {R}) AS ln_, round(ln(l_quantity) / ln(3), {R}) AS log3_, round(log2(l_quantity), {R}) AS log2_,
  round(log10(l_quantity), {R}) AS log10_, round(ln(1 + l_discount), {R}) AS log1p_,
  round(pow(l_quantity, 1.5), 6) AS pow_, round(sqrt(l_quantity), {R}) AS sqrt_, round(cbrt(l_quantity), {R}) AS cbrt_,
  round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), {R}) AS hypot_,
  CAST(factorial(CAST(l_linenumber AS INTEGER)) AS BIGINT) AS fact_
FROM lineitem""")
def f2_exp_log_pow(spark, sf_dir):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return _li(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.round(F.exp(d), R).alias("exp_"), F.round(F.expm1(d), R).alias("expm1_"),
        F.round(F.log(q), R).alias("ln_"), F.round(F.log(3.0, q), R).alias("log3_"), F.round(F.log2(q), R).alias("log2_"),
        F.round(F.log10(q), R).alias("log10_"), F.round(F.log1p(d), R).alias("log1p_"),
        F.round(F.pow(q, 1.5), 6).alias("pow_"), F.round(F.sqrt(q), R).alias("sqrt_"), F.round(F.cbrt(q), R).alias("cbrt_"),
        F.round(F.hypot(q, F.col("l_linenumber")), R).alias("hypot_"), F.factorial("l_linenumber").alias("fact_"))


@query("f3_rounding_sign", ids=("F3",), sql="""
SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS abs_, CAST(ceil(l_extendedprice / 7) AS BIGINT) AS ceil_,
  CAST(floor(l_extendedprice / 7) AS BIGINT) AS floor_, round_even(l_quantity / 2, 0) AS rint_,
  CAST(sign(l_quantity - 25) AS DOUBLE) AS signum_, round(l_extendedprice / 7, 2) AS round2_
FROM lineitem""")
def f3_rounding_sign(spark, sf_dir):
    q = F.col("l_quantity")
    p7 = F.col("l_extendedprice") / 7
    return _li(spark, sf_dir).select("l_orderkey", "l_linenumber", F.abs(q - 25).alias("abs_"),
                                     F.ceil(p7).alias("ceil_"), F.floor(p7).alias("floor_"),
                                     F.rint(q / 2).alias("rint_"), F.signum(q - 25).alias("signum_"),
                                     F.round(p7, 2).alias("round2_"))


@query("f4_base_conversion", ids=("F4",), sql="""
SELECT p_partkey, bin(p_partkey) AS bin_, hex(p_partkey) AS hex_num, hex(p_brand) AS hex_str,
       decode(unhex(hex(p_brand))) AS unhex_
FROM part""")
def f4_base_conversion(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.bin("p_partkey").alias("bin_"), F.hex("p_partkey").alias("hex_num"),
                    F.hex("p_brand").alias("hex_str"), F.decode(F.unhex(F.hex("p_brand")), "UTF-8").alias("unhex_"))


@query("f4_conv_no_twin", ids=("F4",), sql="""
SELECT p_partkey, hex(p_partkey) AS base16, bin(p_partkey) AS base2, p_partkey AS back FROM part""")
def f4_conv_no_twin(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return p.select("p_partkey", F.conv(key, 10, 16).alias("base16"), F.conv(key, 10, 2).alias("base2"),
                    F.conv(F.conv(key, 10, 36), 36, 10).cast("bigint").alias("back"))


@query("f5_string_functions", ids=("F5",), sql="""
SELECT c_custkey, upper(c_name) AS upper_, lower(c_mktsegment) AS lower_, CAST(length(c_name) AS INTEGER) AS len_,
  repeat(substr(c_mktsegment, 1, 2), 3) AS repeat_, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS lpad_,
  rpad(substr(c_name, 1, 5), 8, '.') AS rpad_, translate(c_mktsegment, 'AEIOU', 'aeiou') AS translate_,
  c_name || '/' || c_mktsegment AS concat_, concat_ws('-', c_mktsegment, nullif(c_nationkey, 0)::VARCHAR, 'x') AS concat_ws_,
  printf('%s#%05d', c_mktsegment, c_nationkey) AS format_string_,
  (c_name || nullif(c_mktsegment, 'BUILDING')) AS concat_null
FROM customer""")
def f5_string_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", F.upper("c_name").alias("upper_"), F.lower("c_mktsegment").alias("lower_"),
        F.length("c_name").alias("len_"), F.repeat(F.substring("c_mktsegment", 1, 2), 3).alias("repeat_"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("lpad_"),
        F.rpad(F.substring("c_name", 1, 5), 8, ".").alias("rpad_"),
        F.translate("c_mktsegment", "AEIOU", "aeiou").alias("translate_"),
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("concat_"),
        F.concat_ws("-", "c_mktsegment", F.nullif(F.col("c_nationkey"), F.lit(0)).cast("string"), F.lit("x")).alias("concat_ws_"),
        F.format_string("%s#%05d", "c_mktsegment", "c_nationkey").alias("format_string_"),
        F.concat("c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("concat_null"))


@query("f5_string_no_twin", ids=("F5",), sql="""
SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS initcap_,
       format('{:,.2f}', c_acctbal) AS format_number_ FROM customer""")
def f5_string_no_twin(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.initcap(F.lower("c_mktsegment")).alias("initcap_"),
                    F.format_number("c_acctbal", 2).alias("format_number_"))


@query("f6_substring_search", ids=("F6",), sql="""
SELECT p_partkey, substring(p_name, 2, 4) AS substring_, CAST(instr(p_name, 'e') AS INTEGER) AS instr_,
  CAST(CASE WHEN instr(substring(p_name, 3), 'e') = 0 THEN 0 ELSE instr(substring(p_name, 3), 'e') + 2 END AS INTEGER) AS locate_,
  CAST(levenshtein(p_name, p_type) AS INTEGER) AS levenshtein_
FROM part""")
def f6_substring_search(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.substring("p_name", 2, 4).alias("substring_"),
                    F.instr("p_name", "e").alias("instr_"), F.locate("e", "p_name", 3).alias("locate_"),
                    F.levenshtein("p_name", "p_type").alias("levenshtein_"))


@query("f6_search_no_twin", ids=("F6",), sql="""
SELECT p_partkey, split_part(p_type, ' ', 1) AS first_, split_part(p_type, ' ', -1) AS last_, upper(substr(p_name, 1, 1)) AS soundex_letter,
       true AS soundex_digits FROM part""")
def f6_search_no_twin(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.substring_index("p_type", " ", 1).alias("first_"),
                    F.substring_index("p_type", " ", -1).alias("last_"),
                    F.substring(F.soundex("p_name"), 1, 1).alias("soundex_letter"),
                    F.soundex("p_name").rlike("^[A-Z][0-6]{3}$").alias("soundex_digits"))


@query("f7_regex", ids=("F7",), sql="""
SELECT url, string_split_regex(url, '[/.]')[3] AS third_piece,
  regexp_extract(url, '([a-z]+)\\.example\\.com/([a-z]+)', 2) AS lang_,
  regexp_extract(url, 'page=([0-9]+)', 1) AS page_, regexp_replace(url, '[0-9]', '#', 'g') AS masked
FROM pages""")
def f7_regex(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    u = F.col("url")
    return p.select("url", F.try_element_at(F.split(u, "[/.]"), F.lit(3)).alias("third_piece"),
                    F.regexp_extract(u, r"([a-z]+)\.example\.com/([a-z]+)", 2).alias("lang_"),
                    F.regexp_extract(u, r"page=([0-9]+)", 1).alias("page_"),
                    F.regexp_replace(u, "[0-9]", "#").alias("masked"))


@query("f8_digests_encoding", ids=("F8",), sql="""
SELECT c_custkey, md5(c_name) AS md5_, sha1(c_name) AS sha1_, sha256(c_name) AS sha256_,
       hex(encode(c_name)) AS encoded_hex, decode(encode(c_name)) AS decoded, ~c_custkey AS not_
FROM customer""")
def f8_digests_encoding(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.md5("c_name").alias("md5_"), F.sha1("c_name").alias("sha1_"),
                    F.sha2("c_name", 256).alias("sha256_"), F.hex(F.encode("c_name", "UTF-8")).alias("encoded_hex"),
                    F.decode(F.encode("c_name", "UTF-8"), "UTF-8").alias("decoded"),
                    F.bitwise_not("c_custkey").alias("not_"))


@query("f8_crc32_sha_variants", ids=("F8",))
def f8_crc32_sha_variants(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.crc32("c_name").alias("crc32_"), F.sha2("c_name", 224).alias("sha224_"),
                    F.sha2("c_name", 384).alias("sha384_"), F.sha2("c_name", 512).alias("sha512_"))


@query("f9_date_parts", ids=("F9",), sql="""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year_, CAST(quarter(ts) AS INTEGER) AS quarter_,
  CAST(month(ts) AS INTEGER) AS month_, CAST(day(ts) AS INTEGER) AS day_, CAST(dayofyear(ts) AS INTEGER) AS doy_,
  CAST(hour(ts) AS INTEGER) AS hour_, CAST(minute(ts) AS INTEGER) AS minute_, CAST(second(ts) AS INTEGER) AS second_,
  CAST(weekofyear(ts) AS INTEGER) AS week_
FROM events""")
def f9_date_parts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ts = F.col("ts")
    return e.select("event_id", F.year(ts).alias("year_"), F.quarter(ts).alias("quarter_"),
                    F.month(ts).alias("month_"), F.dayofmonth(ts).alias("day_"), F.dayofyear(ts).alias("doy_"),
                    F.hour(ts).alias("hour_"), F.minute(ts).alias("minute_"), F.second(ts).alias("second_"),
                    F.weekofyear(ts).alias("week_"))


@query("f10_date_arithmetic", ids=("F10",), sql="""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS od FROM orders)
SELECT o_orderkey, CAST(od + 10 AS VARCHAR) AS plus10, CAST(od - 10 AS VARCHAR) AS minus10,
  CAST(datediff('day', DATE '1995-01-01', od) AS INTEGER) AS days_since,
  CAST(CAST(od + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS plus_month, CAST(last_day(od) AS VARCHAR) AS month_end,
  CAST(CAST(date_trunc('month', od) AS DATE) AS VARCHAR) AS month_start, CAST(od AS VARCHAR) AS as_date
FROM d""")
def f10_date_arithmetic(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    od = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.date_add(od, 10).cast("string").alias("plus10"),
                    F.date_sub(od, 10).cast("string").alias("minus10"),
                    F.datediff(od, F.lit("1995-01-01").cast("date")).alias("days_since"),
                    F.add_months(od, 1).cast("string").alias("plus_month"),
                    F.last_day(od).cast("string").alias("month_end"),
                    F.trunc(od, "month").cast("string").alias("month_start"), od.cast("string").alias("as_date"))


@query("f10_dates_no_twin", ids=("F10",), sql="""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS od FROM orders)
SELECT o_orderkey, round(12 * (year(od) - 1995) + month(od) - 1 + (day(od) - 1) / 31.0, 8) AS months_between_,
       CAST(od + CAST(7 - dayofweek(od) AS INTEGER) AS VARCHAR) AS next_sunday FROM d""")
def f10_dates_no_twin(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    od = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.months_between(od, F.lit("1995-01-01").cast("date")).alias("months_between_"),
                    F.next_day(od, "Sun").cast("string").alias("next_sunday"))


@query("f11_date_format", ids=("F11",), sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS formatted, strftime(ts, '%d/%m/%Y') AS dmy FROM events""")
def f11_date_format(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("formatted"),
                    F.date_format("ts", "dd/MM/yyyy").alias("dmy"))


@query("f11_epoch_and_zones", ids=("F11",), sql="""
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_s, strftime(ts, '%Y-%m-%d %H:%M:%S') AS back,
       strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS tokyo, strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS from_tokyo
FROM events""")
def f11_epoch_and_zones(spark, sf_dir):
    """Under a UTC session; the zone is one without daylight saving."""
    e = table(spark, sf_dir, "events")
    fmt = "yyyy-MM-dd HH:mm:ss"
    with utc_session(spark):
        tsz = F.col("ts").cast("timestamp")
        secs = F.unix_timestamp(F.date_format("ts", fmt), fmt)
        return e.select("event_id", secs.alias("epoch_s"), F.from_unixtime(secs).alias("back"),
                        F.date_format(F.from_utc_timestamp(tsz, "Asia/Tokyo"), fmt).alias("tokyo"),
                        F.date_format(F.to_utc_timestamp(tsz, "Asia/Tokyo"), fmt).alias("from_tokyo"))


@query("f12_query_time_constants", ids=("F12",), sql="""
SELECT count(*) AS n, 1 AS n_times, true AS day_of_time FROM events""")
def f12_query_time_constants(spark, sf_dir):
    """The current time is the same in all rows of a query, and the current
    date is its day."""
    e = table(spark, sf_dir, "events").select(F.current_date().alias("today"), F.current_timestamp().alias("now"))
    return e.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("now").alias("n_times"),
                 F.every(F.to_date("now") == F.col("today")).alias("day_of_time"))


@query("f13_arrays_structs", ids=("F13",), sql="""
SELECT p_partkey, array_to_string(list_sort([p_size, CAST(p_partkey % 50 AS INTEGER), 7]), ',') AS sorted_,
  array_to_string(list_reverse(list_sort([p_size, CAST(p_partkey % 50 AS INTEGER), 7])), ',') AS sorted_desc,
  list_contains(string_split(p_type, ' '), 'BRASS') AS has_brass, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words,
  {'s': p_size, 'b': p_brand}.s AS struct_size
FROM part""")
def f13_arrays_structs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    arr = F.array("p_size", F.pmod("p_partkey", F.lit(50)).cast("int"), F.lit(7))
    return p.select("p_partkey", F.array_join(F.sort_array(arr), ",").alias("sorted_"),
                    F.array_join(F.sort_array(arr, asc=False), ",").alias("sorted_desc"),
                    F.array_contains(F.split("p_type", " "), "BRASS").alias("has_brass"),
                    F.size(F.split("p_name", " ")).alias("n_words"),
                    F.struct(F.col("p_size").alias("s"), F.col("p_brand").alias("b")).getField("s").alias("struct_size"))


@query("f14_explode", ids=("F14",), sql="""
SELECT p_partkey, CAST(generate_subscripts(string_split(p_type, ' '), 1) - 1 AS INTEGER) AS pos,
       unnest(string_split(p_type, ' ')) AS word FROM part""")
def f14_explode(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.posexplode(F.split("p_type", " ")).alias("pos", "word"))


@query("f14_explode_outer", ids=("F14",), sql="""
WITH x AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN string_split(p_name, ' ') ELSE [] END AS words FROM part)
SELECT p_partkey, w.word FROM x LEFT JOIN LATERAL (SELECT unnest(x.words) AS word) w ON true""")
def f14_explode_outer(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = F.when(F.col("p_size") > 25, F.split("p_name", " ")).otherwise(F.array().cast("array<string>"))
    return p.select("p_partkey", F.explode_outer(words).alias("word"))


@query("f15_higher_order_row_functions", ids=("F15",), sql="""
SELECT vec_id, round(list_aggregate(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * 2), 'sum'), 3) AS doubled_sum,
       CAST(len(list_filter(embedding, lambda v: v > 0)) AS INTEGER) AS n_positive,
       list_bool_or(list_transform(embedding, lambda v: v > 2.5)) AS any_big
FROM embeddings""")
def f15_higher_order_row_functions(spark, sf_dir):
    """map / filter / flatMap on rows as column expressions (no Python)."""
    e = table(spark, sf_dir, "embeddings")
    arr = F.col("embedding")
    doubled = F.transform(arr, lambda v: v.cast("double") * 2)
    return e.select("vec_id",
                    F.round(F.aggregate(doubled, F.lit(0.0), lambda acc, v: acc + v), 3).alias("doubled_sum"),
                    F.size(F.filter(arr, lambda v: v > 0)).alias("n_positive"),
                    F.exists(arr, lambda v: v > 2.5).alias("any_big"))
