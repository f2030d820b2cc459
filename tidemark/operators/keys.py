"""Key membership, duplicate keys and row numbering that hold up when one key owns a large share of rows.

Groups are counted with map-side combining and only the resulting key set meets the rows again in a join.
The rows of a hot key are never gathered in one task: adaptive execution splits them in that join, and the key
set itself is broadcast only when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, is_filled
from tidemark.session import materialize


def flag_members(df: DataFrame, value: Column, members: DataFrame, flag: str, unique: bool = False) -> DataFrame:
    """Boolean column `flag`: is `value` among the values of the one-column frame `members`.

    `unique` promises that no member occurs twice, which saves a shuffle of the members.
    """
    key = f"__key_{flag}"
    keys = members.select(F.col(members.columns[0]).alias(key))
    keys = keys if unique else keys.distinct()
    joined = df.join(keys, value == F.col(key), "left")
    return joined.withColumn(flag, F.col(key).isNotNull()).drop(key)


def key_counts(df: DataFrame, keys: list[str], count_name: str = "count") -> DataFrame:
    """Rows per key; NULL is a key like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def duplicate_keys(df: DataFrame, keys: list[str], filled_only: bool = False) -> DataFrame:
    """Keys with more than one row. `filled_only` leaves NULL and blank keys out before counting."""
    rows = df.filter(all_of([is_filled(F.col(k)) for k in keys])) if filled_only else df
    return key_counts(rows, keys, "__n").filter("__n > 1").drop("__n")


def flag_rows_with_keys(df: DataFrame, keys: list[str], key_set: DataFrame, flag: str) -> DataFrame:
    """Boolean column `flag`: is the (NULL-safe) key of the row in `key_set`, which has each key once."""
    marked = key_set.select(*[F.col(k).alias(f"__{flag}_{i}") for i, k in enumerate(keys)], F.lit(True).alias(flag))
    condition = all_of([F.col(k).eqNullSafe(F.col(f"__{flag}_{i}")) for i, k in enumerate(keys)])
    joined = df.join(marked, condition, "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop(
        *[f"__{flag}_{i}" for i in range(len(keys))]
    )


def rows_with_keys(df: DataFrame, keys: list[str], key_set: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose (NULL-safe) key is in (`left_semi`) or not in (`left_anti`) the key set."""
    renamed = key_set.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    condition = all_of([F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return df.join(renamed, condition, how)


def join_grouped(df: DataFrame, keys: list[str], other: DataFrame, found: Column) -> DataFrame:
    """Left join with the aggregate `found` of the other frame's rows of the same key, in which NULLs are equal.

    The key is one struct behind its hash: the groups are exchanged once, for grouping and join, and sorting compares numbers.
    """
    columns = [F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys]
    hashed, key = F.xxhash64(*columns).alias("__hash"), F.struct(*columns).alias("__key")
    groups = other.groupBy(hashed, key).agg(found)
    rest = [F.col(c) for c in df.columns if c not in keys]
    joined = df.select(hashed, key, *rest).join(groups, ["__hash", "__key"], "left")
    back = [F.col(f"__key.{c}").alias(c) if c in keys else F.col(c) for c in df.columns]
    return joined.select(*back, *[c for c in groups.columns if c not in ("__hash", "__key")])


def flag_duplicates(df: DataFrame, keys: list[str], flag: str, filled_only: bool = False) -> DataFrame:
    """Boolean column `flag`: does another row share the key."""
    return flag_rows_with_keys(df, keys, duplicate_keys(df, keys, filled_only), flag)


def number_rows(df: DataFrame, order_by: list[str], group_by: list[str] = (), name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 1 in the given order, over everything or within each group.

    A window without partitions (or over one hot group) would put those rows in one task. Here the rows are
    range-partitioned and sorted, each partition numbers its own rows, and the counts of the partitions before it
    are added. Only those counts, at most one row per partition and group, pass through a window. The ranged rows
    are written once, because the partition layout must be the same in both steps.
    Ties are broken by the content of the row, and copies of one row by the partition they come from (which a
    retried task sees again), so even a huge group of copies is spread over partitions.
    """
    spark = df.sparkSession
    groups = list(group_by)
    columns = df.columns
    tie = F.xxhash64(*[F.col(c) for c in columns]).alias("__tie")
    sort_columns = [*groups, *order_by, "__tie", "__origin"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = (
        df.select(*columns, tie, F.spark_partition_id().alias("__origin"))
        .repartitionByRange(parts, *sort_columns)
        .sortWithinPartitions(*sort_columns)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    staged = (
        materialize(ranged.select(*columns, "__id"))
        .withColumn("__part", F.shiftright("__id", 33))
        .withColumn("__index", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = staged.groupBy("__part", *groups).agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__index").alias("__first")
    )
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("__part").alias("__p"),
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first") + 1).alias("__offset"),
    )
    # One row per partition, or per partition and group: written, so that the planner knows how few they are.
    offsets = materialize(offsets) if groups else F.broadcast(offsets)
    condition = all_of(
        [F.col("__part") == F.col("__p"), *[F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]]
    )
    numbered = staged.join(offsets, condition, "inner")
    return numbered.select(*columns, (F.col("__index") + F.col("__offset")).cast("bigint").alias(name))


# Up to this many hashes are sent to all tasks as a list.
SENT_HASHES = 1_000_000
# A filter of hashes has 2 ** 28 bits, 32 MB, in pieces of 2 ** 9; with more than a quarter of them set it is not worth sending.
FILTER_BITS, MAP_BITS, PIECE_BITS = 28, 15, 9  # MAP_BITS: of a bitmap of `bitmap_construct_agg`
FULL = 1 << (FILTER_BITS - 2)
# Copies of one row that are written out one after the other; more are dealt over tasks.
COPIES = 4096


def _copies(df: DataFrame) -> DataFrame:
    """Adds `__copy`, the number of a row among those with equal `__identity` and `__content`.

    Of equal rows only their number travels; they are written out again afterwards.
    """
    keys, one = ["__identity", "__content"], F.lit(1).cast("bigint")
    rest = [F.first(c).alias(c) for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *rest)
    few = counted.filter(F.col("__n") <= COPIES).withColumn("__copy", F.explode(F.sequence(one, F.col("__n"))))
    many = counted.filter(F.col("__n") > COPIES)
    many = many.withColumn("__from", F.explode(F.sequence(one, F.col("__n"), F.lit(COPIES).cast("bigint"))))
    until = F.least(F.col("__from") + F.lit(COPIES - 1), F.col("__n"))
    many = many.repartition(*keys, "__from").withColumn("__copy", F.explode(F.sequence("__from", until)))
    return few.unionByName(many.drop("__from")).drop("__n")


def _place(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - FILTER_BITS)


def _low_bits(place: Column, bits: int) -> Column:
    return place.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def filter_of(hashes: DataFrame) -> DataFrame:
    """A filter of the 64-bit hashes in a one-column frame, written to scratch: the pieces that have a bit set."""
    place = _place(F.col(hashes.columns[0]))
    maps = hashes.groupBy(F.shiftright(place, MAP_BITS).cast("int").alias("__map"))
    maps = maps.agg(F.bitmap_construct_agg(_low_bits(place, MAP_BITS)).alias("__bits"))
    size, several = 1 << (PIECE_BITS - 3), 1 << (MAP_BITS - PIECE_BITS)
    pieces = maps.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(several - 1))))
    pieces = pieces.select(
        (F.col("__map") * several + F.col("__at")).alias("__piece"),
        F.expr(f"substring(__bits, __at * {size} + 1, {size})").alias("__bits"),
    )
    return materialize(pieces.filter(F.bitmap_count("__bits") > 0))


def is_full(sent: DataFrame) -> bool:
    """Would a filter let too many others through to be worth sending."""
    return (sent.agg(F.sum(F.bitmap_count("__bits"))).first()[0] or 0) > FULL


def flag_like(df: DataFrame, hashed: Column, sent: DataFrame, flag: str) -> DataFrame:
    """Boolean column `flag`: may the hash be one that the filter was made of. The filter goes to the rows, which stay in place."""
    placed = df.withColumn("__place", _place(hashed))
    met = placed.join(F.broadcast(sent), F.shiftright("__place", PIECE_BITS).cast("int") == F.col("__piece"), "left")
    met = met.withColumn("__bit", _low_bits(F.col("__place"), PIECE_BITS))
    byte = F.expr("CAST(conv(hex(substring(__bits, __bit DIV 8 + 1, 1)), 16, 10) AS INT)")
    bit = F.call_function("shiftright", byte, F.expr("__bit % 8")).bitwiseAND(F.lit(1))
    return met.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop("__place", "__piece", "__bits", "__bit")


def split_repeated(stored: DataFrame, short: Column) -> tuple[DataFrame | None, DataFrame]:
    """Rows of a stored frame whose short hash occurs once, and the others.

    The repeated hashes travel as a filter, so some rows are among the others by chance; with too many for it, all are.
    """
    repeated = key_counts(stored.select(short.alias("__short")), ["__short"], "__n").filter("__n > 1")
    sent = filter_of(repeated.select("__short"))
    if is_full(sent):
        return None, stored
    marked = flag_like(stored, short, sent, "__like")
    return marked.filter("NOT __like").drop("__like"), marked.filter("__like").drop("__like")


def rows_and_values(df: DataFrame, column: str, rows: str, values: str) -> DataFrame:
    """One row: the number of rows and of different values (NULL is none).

    What is exchanged are hashes; only values that share one with another row are compared as they are.
    """
    marked = df.withColumn("__short", F.when(F.col(column).isNotNull(), F.xxhash64(column)))
    counts = key_counts(marked, ["__short"], "__n")
    known = F.col("__short").isNotNull()
    shared = known & (F.col("__n") > 1)
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.count("__short").alias("h"), F.count_if(shared).alias("s")).first()
    found = total["h"] - total["s"]
    if total["s"]:
        again = rows_with_keys(marked, ["__short"], materialize(counts.filter(shared).select("__short")))
        found += again.agg(F.count_distinct(column)).first()[0]
    numbers = (F.lit(total["n"]).cast("bigint").alias(rows), F.lit(found).cast("bigint").alias(values))
    return df.sparkSession.range(1).select(*numbers)


def _hashed(df: DataFrame, identity: Column) -> DataFrame:
    return df.withColumns({"__identity": F.unhex(F.sha2(identity, 256)), "__content": F.xxhash64(*df.columns)})


def _numbered(alone: list[DataFrame | None], others: DataFrame, name: str) -> DataFrame:
    """The id of hashed rows. Those that are `alone` have an identity of their own; equal ones of the others are numbered."""
    rows = _copies(others)
    for single in alone:
        if single is not None:
            rows = single.withColumn("__copy", F.lit(1).cast("bigint")).unionByName(rows)
    code = F.concat_ws("#", F.hex("__identity"), F.col("__content").cast("string"), F.col("__copy").cast("string"))
    return rows.withColumn(name, F.sha2(code, 256)).drop("__identity", "__content", "__copy")


def with_unique_id(df: DataFrame, name: str, identity: Column, stored: bool = False, alone: Column | None = None) -> DataFrame:
    """A stored id per row: the hash of its identity, its content and its number among equal rows.

    A row gets the same id whatever other rows there are, and equal rows the same set of ids whenever they are computed.
    Short hashes of the identities are counted first; rows whose hash occurs once need nothing else, and those that the caller knows
    to be `alone` with their identity not even that. The frame is read several times, so it is written once unless it is `stored`:
    read from files, and the same at every reading.
    """
    hashed = _hashed(df, identity)
    hashed = hashed if stored else materialize(hashed)
    sure, open_rows = None, hashed
    if alone is not None:
        known = F.coalesce(alone, F.lit(False))
        sure, open_rows = hashed.filter(known), hashed.filter(~known)
    single, others = split_repeated(open_rows, F.xxhash64("__identity"))
    return _numbered([sure, single], others, name).select(*df.columns, name)


def unfolded_with_unique_id(
    stored: DataFrame, row_hash: str, unfold: Callable[[DataFrame], DataFrame], name: str, identity: Column
) -> DataFrame:
    """The ids of `with_unique_id` for what `unfold` makes of stored rows, without storing that.

    Only rows of one `row_hash` may unfold into equal identities, and one row never into two of them. So hashes of
    rows are counted, and only rows that share one are numbered.
    """
    alone, others = split_repeated(stored, F.xxhash64(row_hash))
    return _numbered([None if alone is None else _hashed(unfold(alone), identity)], _hashed(unfold(others), identity), name)
