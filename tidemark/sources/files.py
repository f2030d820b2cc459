"""CSV and JSON sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keys import duplicate_keys
from tidemark.session import materialize

BATCH_COLUMN = "ingest_date"
BATCH_IN_PATH = r"ingest_date=([0-9-]+)"

_TEXT, _LONG, _BOOL = T.StringType(), T.LongType(), T.BooleanType()

# Field names of the nested deliveries. Scalars of a chatbot session, in output order around the nested leaves.
SESSION_HEAD = [
    "session_id", "channel", "device_type", "os", "app_version", "started_at", "ended_at", "duration_seconds",
    "entry_login_status", "is_logged_in", "customer_id", "consent_screen_shown", "consent_privacy_accepted",
    "consent_marketing_accepted", "consent_thirdparty_accepted", "consent_answered_at", "product_interest",
    "login_gate_hit", "mobile_only_redirect", "external_site_redirect", "accident_claim",
    "contract_change_request", "benefit_event_interaction", "resolution", "intent_category_guess",
]
# Output column -> field of a navigation step, and of a query.
NAVIGATION = {
    "nav_step": "step",
    "nav_menu_level": "menu_level",
    "nav_menu_name": "menu_name",
    "nav_full_path": "full_path",
    "nav_timestamp": "timestamp",
}
QUERY = {
    "user_query": "query",
    "query_matched": "matched",
    "query_matched_items": "matched_items",
    "query_timestamp": "timestamp",
}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _TEXT, True) for c in columns])


def batch_of_path() -> Column:
    """Batch date from the path of the file a row came from; `unknown` when the path has none."""
    return F.coalesce(F.nullif(F.regexp_extract(F.input_file_name(), BATCH_IN_PATH, 1), F.lit("")), F.lit("unknown"))


def read_csv(spark: SparkSession, path: str, columns: list[str], pattern: str | None = None) -> DataFrame:
    """CSV with a header, every column kept as text. No inference pass over the data."""
    reader = spark.read.option("header", True).schema(text_schema(columns))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def read_csv_batches(spark: SparkSession, base: str, columns: list[str], latest_only: bool = True) -> DataFrame:
    """All `ingest_date=` folders of a source, or only the newest. The folder name is the partition column."""
    schema = text_schema([*columns, BATCH_COLUMN])
    frame = spark.read.option("header", True).option("basePath", base).schema(schema).csv(base)
    return latest_batch(frame, BATCH_COLUMN) if latest_only else frame


def latest_batch(df: DataFrame, column: str = BATCH_COLUMN) -> DataFrame:
    """Rows of the newest batch. The maximum is a scalar subquery, so a partition column prunes at run time."""
    newest = df.agg(F.max(F.nullif(F.col(column), F.lit(""))).alias("m")).scalar()
    return df.filter(F.col(column) == newest)


def newest_batch_folder(spark: SparkSession, base: str) -> tuple[str, str]:
    """(folder, batch) of the newest `ingest_date=` folder. Only file names are listed, no content is read."""
    listing = spark.read.format("binaryFile").load(base)
    if BATCH_COLUMN not in listing.columns:
        raise FileNotFoundError(f"{base} has no {BATCH_COLUMN}= folder")
    batch = listing.agg(F.max(F.col(BATCH_COLUMN).cast("string"))).first()[0]
    return f"{base.rstrip('/')}/{BATCH_COLUMN}={batch}", batch


def read_metadata_csv(spark: SparkSession, path: str, ordinal: str | None = None, key: str | None = None) -> DataFrame:
    """Metadata in one file or a folder of files: all text, byte-order marks allowed, blank cells as NULL.

    The first file by name has a header; each other one may repeat it or begin with data. `ordinal` numbers the lines
    through all files in the order of their names. `key` names a column whose values must be unique.

    A file is read whole by one task, so ids that rise within a task give places within a file. The lines are written
    once, which fixes these ids; the lines of the files before are then added, one row per file.
    """
    raw = spark.read.option("nullValue", "").option("emptyValue", "").option("multiLine", True).csv(path)
    cells = raw.columns
    lines = materialize(
        raw.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__id"))
    )
    starts = lines.groupBy(F.col("__file").alias("__of")).agg(F.min("__id").alias("__start"))
    placed = lines.join(starts, F.col("__file") == F.col("__of")).withColumn("__top", F.col("__id") == F.col("__start"))
    unmarked = F.when(F.col("__top"), F.ltrim(F.col(cells[0]), F.lit("\ufeff"))).otherwise(F.col(cells[0]))
    placed = placed.withColumn(cells[0], unmarked)
    tops = placed.filter("__top").select("__file", F.array(*cells).alias("__cells"))
    first = tops.orderBy("__file").first()
    if first is None or not all(first["__cells"]):
        raise ValueError(f"{path}: the first file has no complete header")
    names = first["__cells"]
    listed = F.array(*map(F.lit, names))
    other_order = F.array_sort("__cells").eqNullSafe(F.array_sort(listed)) & ~F.col("__cells").eqNullSafe(listed)
    strange = tops.filter(other_order).first()
    if strange:
        raise ValueError(f"{strange['__file']}: the header has the columns in another order than {first['__file']}")
    body = placed.filter(~(F.col("__top") & F.array(*cells).eqNullSafe(listed)))
    frame = body.select(*[F.nullif(F.col(c), F.lit("")).alias(n) for c, n in zip(cells, names)], "__file", "__id")
    if key:
        found = duplicate_keys(frame, [key])
        repeated = [r[0] for r in found.limit(20).collect()]
        if repeated:
            raise ValueError(f"{path}: {found.count()} values of {key} are repeated, nothing was loaded: {repeated} ...")
    if not ordinal:
        return frame.select(*names)
    sizes = frame.groupBy(F.col("__file").alias("__of")).agg(F.count(F.lit(1)).alias("__lines"), F.min("__id").alias("__first"))
    inventory = F.sort_array(F.collect_list(F.struct("__of", "__lines", "__first")))  # one entry per file
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<of:string,offset:bigint>>").alias("done"))
    counted = F.aggregate(
        inventory,
        start,
        lambda s, f: F.struct(
            (s["at"] + f["__lines"]).alias("at"),
            F.concat(s["done"], F.array(F.struct(f["__of"].alias("of"), (s["at"] - f["__first"] + 1).alias("offset")))).alias("done"),
        ),
    )
    offsets = sizes.agg(F.explode(counted["done"]).alias("o")).select(F.col("o.of").alias("__of"), F.col("o.offset").alias("__offset"))
    numbered = frame.join(offsets, F.col("__file") == F.col("__of"))
    return numbered.select((F.col("__id") + F.col("__offset")).cast("string").alias(ordinal), *names)


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def _leaf(owner: str, fields: dict[str, T.DataType], name: str) -> Column:
    """Text of a nested field: plain text as it is, scalars cast, structs and arrays as JSON, absent as NULL."""
    kind = fields.get(name)
    if kind is None:
        return F.lit(None).cast("string")
    field = F.col(f"{owner}.{name}")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(field)
    return field.cast("string")


def flatten_sessions(raw: DataFrame) -> DataFrame:
    """Nested sessions to one row per session, navigation entry and query (missing lists keep the session)."""
    sessions = raw.select(F.explode("sessions").alias("s")) if "sessions" in raw.columns else raw.select("s")

    def fields(kind: T.DataType) -> dict[str, T.DataType]:
        element = kind.elementType if isinstance(kind, T.ArrayType) else kind
        return {f.name: f.dataType for f in element.fields} if isinstance(element, T.StructType) else {}

    session = fields(sessions.schema["s"].dataType)
    head = [_leaf("s", session, c).alias(c) for c in SESSION_HEAD]

    def listed(name: str) -> Column:
        return F.col(f"s.{name}") if name in session else F.array(F.lit(None).cast("string"))

    nested = (
        sessions.select(*head, listed("navigation_path").alias("navs"), listed("free_text_queries").alias("queries"))
        .select(*SESSION_HEAD, "queries", F.explode_outer("navs").alias("nav"))
        .select(*SESSION_HEAD, "nav", F.explode_outer("queries").alias("query"))
    )
    nav, query = fields(nested.schema["nav"].dataType), fields(nested.schema["query"].dataType)
    return nested.select(
        *SESSION_HEAD,
        *[_leaf("nav", nav, field).alias(out) for out, field in NAVIGATION.items()],
        *[_leaf("query", query, field).alias(out) for out, field in QUERY.items()],
    )


def read_sessions(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Nested session files (`*.json`, all of them). Give a schema to skip the inference pass over the data.

    A multi-line document is read by one task; large deliveries should come as JSON lines (`multi_line=False`).
    """
    reader = spark.read.option("multiLine", multi_line).option("pathGlobFilter", "*.json")
    return flatten_sessions((reader.schema(schema) if schema else reader).json(path))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV copy of a result, with the frame's own partitioning (small results arrive as one file)."""
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
