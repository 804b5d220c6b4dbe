"""Delimited metering records: header drop, parsing, bucketing, folds.

Everything here is a Column expression inside one Catalyst plan; nothing is
gathered per bucket.  Bad records are kept as flagged rows (``is_bad``) so
their count can be observed, and are filtered before any fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.indexing import index_within_groups

# Position of each named field in a ';'-separated household
# power record (field 0 is the date, which is not used).
FIELD_POSITION = {
    "time": 1,
    "global_active_power": 2,
    "global_reactive_power": 3,
    "voltage": 4,
    "global_intensity": 5,
    "sub_metering_1": 6,
    "sub_metering_2": 7,
    "sub_metering_3": 8,
}
# The default inputs and target of the household regression.
DEFAULT_INPUTS = ["time", "global_reactive_power", "voltage", "global_intensity",
                  "sub_metering_1", "sub_metering_2", "sub_metering_3"]
DEFAULT_TARGET = "global_active_power"
MIN_FIELDS = 9          # a record needs fields 0..8
SENTINEL_INPUTS = 7     # a bad record always carries 7 inputs


def drop_header(lines: DataFrame, col: str = "value", order_by: str | None = None, header: str | None = None) -> DataFrame:
    """Drop every line equal to the first line (not just line one).

    ``header`` is that line, if known; else ``order_by`` names the column
    that defines "first", and lines read from files are taken in the order of
    file name and position.  Spark reads large splits first, so the first row
    it returns is not the first line.  Only one row reaches the driver.
    """
    if header is None:
        place = [F.col(order_by)] if order_by else [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                                    F.monotonically_increasing_id()]
        placed = lines.select(F.col(col).alias("line"), F.struct(*(p.alias(f"p{i}") for i, p in enumerate(place))).alias("place"))
        header = placed.agg(F.min_by("line", "place")).first()[0]
    return lines if header is None else lines.filter(F.col(col) != F.lit(header))


def _py_number(c: Column) -> Column:
    # Python's float()/int() accept single underscores between digits
    # ("1_0" == 10); Spark's cast does not, so drop those first.
    return F.regexp_replace(c, "(?<=[0-9])_(?=[0-9])", "")


#: What Python's float() and int() read, underscores taken out; Spark's casts
#: also read forms like 1.5d, 2f and 0x1p3.
_FLOAT = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"
_INT = r"^\s*[+-]?[0-9]+\s*$"


def _as_double(c: Column) -> Column:
    # What float() doesn't read becomes 0.0, as in the reference.
    number = _py_number(c)
    return F.when(number.rlike(_FLOAT), F.coalesce(number.try_cast("double"), F.lit(0.0))).otherwise(0.0)


def minute_of_day(c: Column) -> Column:
    """``HH:MM[:SS]`` -> minutes since midnight; unparsable -> 0."""
    hm = F.split(c, ":", -1)
    h, m = (_py_number(F.try_element_at(hm, F.lit(i))) for i in (1, 2))
    whole = [F.when(x.rlike(_INT), F.trim(x).try_cast("int")) for x in (h, m)]
    return F.coalesce(whole[0] * 60 + whole[1], F.lit(0))


def record_time(col: str = "value", sep: str = ";") -> tuple[Column, Column]:
    """(day, second) of a record, to order records in time: field 0 is the
    date as day/month/year, field 1 the time as H:M:S.  NULL if unreadable."""
    parts = F.split(F.col(col), sep, -1)
    dmy, hms = (F.split(F.try_element_at(parts, F.lit(i)), p, -1) for i, p in ((1, "/"), (2, ":")))

    def number(a: Column, i: int) -> Column:
        return F.try_element_at(a, F.lit(i)).try_cast("int")

    return (number(dmy, 3) * 10_000 + number(dmy, 2) * 100 + number(dmy, 1),
            number(hms, 1) * 3600 + number(hms, 2) * 60 + F.coalesce(number(hms, 3), F.lit(0)))


def parse_records(lines: DataFrame, inputs: list[str] = DEFAULT_INPUTS,
                  target: str = DEFAULT_TARGET, col: str = "value", sep: str = ";",
                  keep: list[str] | None = None) -> DataFrame:
    """Split each record and project named inputs and the target by position.

    Records with fewer than 9 fields become the sentinel row: minute -1,
    zero inputs, zero target, ``is_bad`` true.  Output columns: ``keep``,
    then one double per input (``time`` as minute of day), ``target``,
    ``is_bad``.
    """
    parts = F.split(F.col(col), sep, -1)
    ok = F.size(parts) >= MIN_FIELDS

    def field(name: str) -> Column:
        raw = F.try_element_at(parts, F.lit(FIELD_POSITION[name] + 1))
        if name == "time":
            return minute_of_day(raw).cast("double")
        return _as_double(raw)

    out = [F.col(k) for k in (keep or [])]
    for i, name in enumerate(inputs):
        bad_value = -1.0 if i == 0 else 0.0
        out.append(F.when(ok, field(name)).otherwise(F.lit(bad_value)).alias(name))
    out.append(F.when(ok, field(target)).otherwise(F.lit(0.0)).alias("target"))
    out.append((~ok).alias("is_bad"))
    return lines.select(*out)


def good_rows(parsed: DataFrame, first_input: str = DEFAULT_INPUTS[0]) -> DataFrame:
    """Rows the fit may use: not flagged, and minute not -1."""
    return parsed.filter(~F.col("is_bad") & (F.col(first_input) != -1))


def assign_bucket(df: DataFrame, key_cols: list[str], n: int = 10, method: str = "hash",
                  seed: int = 42, out: str = "bucket") -> DataFrame:
    """Spread rows uniformly over buckets 1..n.

    ``hash`` (default) is repeatable on task retry; ``mod`` is ``key % n``
    for an integer key; ``random`` is seeded ``rand``.
    """
    if method == "hash":
        b = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]), F.lit(n)) + 1
    elif method == "mod":
        b = F.pmod(F.col(key_cols[0]), F.lit(n)) + 1
    elif method == "random":
        b = F.floor(F.rand(seed) * n) + 1
    else:
        raise ValueError(f"unknown bucket method {method!r}")
    return df.withColumn(out, b.cast("int"))


def assign_folds(df: DataFrame, k: int, order_cols: list[str], group_col: str = "bucket",
                 shuffle: bool = False, seed: int = 0, out: str = "fold",
                 keep_index: bool = False,
                 keep_cols: list[str] | None = None) -> DataFrame:
    """Contiguous k folds inside each group.

    n_each = floor(n / k); fold = min(floor(idx / n_each), k - 1), so the
    last fold takes the rest.  A group with n < k raises.  ``shuffle``
    orders by a seeded hash of the order columns instead of the columns.
    The position inside the group is computed without sending a group to a
    single task (see ``index_within_groups``).
    """
    base = df
    order = order_cols
    if shuffle:
        base = df.withColumn("_shuffle_key", F.xxhash64(F.lit(seed), *[F.col(c) for c in order_cols]))
        order = ["_shuffle_key", *order_cols]
    # group sizes come with the index (summed from its span table)
    # the tagged rows are written once (Parquet, shared folder); spans are a
    # three-column scan of that table, and the fold is a narrow broadcast join
    indexed = index_within_groups(base, [group_col], order, index_col="_idx", size_col="_n",
                                  keep_cols=keep_cols)
    n_each = F.floor(F.col("_n") / F.lit(k))
    each = (F.when(n_each == 0, F.raise_error(F.lit("a group has fewer rows than folds")))
             .otherwise(n_each).cast("long"))
    out_df = indexed.withColumn("_each", each)
    fold = F.least(F.floor(F.col("_idx") / F.col("_each")), F.lit(k - 1)).cast("int")
    res = out_df.withColumn(out, fold).drop("_each")
    res = res.withColumnRenamed("_idx", "idx") if keep_index else res.drop("_idx")
    if shuffle:
        res = res.drop("_shuffle_key")
    return res.withColumnRenamed("_n", "n_in_group")
