"""Scans, sinks, profiling, projection/filter verbs, sorting and top-k."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..oracle import with_
from ..operators import series as S
from ..operators import stats as T
from ..operators import verbs as V
from ..operators.pairs import align_wide
from ..plans import adapters as A
from ..session import scratch_path
from ..sources import files as FS
from ..sources.tables import read_table
from ._base import r6, register

CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
CENSUS_SCHEMA = ("id BIGINT, age BIGINT, workclass STRING, education_num BIGINT, race STRING, sex STRING, "
                 "native_country STRING, capital_gain DOUBLE, hours_per_week BIGINT, income STRING")
CENSUS_COLS = ["id", "age", "workclass", "education_num", "race", "sex", "native_country", "capital_gain",
               "hours_per_week", "income"]


@register("scan_csv_header", "SELECT * FROM customer")
def scan_csv_header(spark, sf):
    """Write the table as CSV with a header, read it back with an explicit
    schema (no inference pass)."""
    path = scratch_path(spark, "csv_header")
    FS.write_csv(read_table(spark, sf, "customer"), path)
    return FS.read_csv(spark, path, CUSTOMER_SCHEMA, header=True)


@register("scan_csv_headerless", with_("census_null") + "SELECT * FROM census_null")
def scan_csv_headerless(spark, sf):
    """Headerless lines with a blank after each comma and '?' for missing
    values; read back with named columns, leading blanks skipped and '?'
    turned into NULL."""
    path = scratch_path(spark, "csv_headerless")
    FS.write_delimited_lines(A.census(spark, sf), path, sep=", ")
    return FS.read_csv(spark, path, CENSUS_SCHEMA, header=False, ignore_leading_blank=True, null_value="?")


@register("sentinel_to_null", with_("census_null") + "SELECT * FROM census_null")
def sentinel_to_null(spark, sf):
    return V.nulls_from_sentinel(A.census(spark, sf), "?")


@register("scan_text_docs", "SELECT doc_id, text FROM documents")
def scan_text_docs(spark, sf):
    """One file per document, the id taken from the file's name."""
    path = scratch_path(spark, "docs")
    FS.write_documents(read_table(spark, sf, "documents"), path, "doc_id", "text")
    return FS.read_documents(spark, path, "doc_id", "text")


@register("scan_date_range", with_(extra={"prices": """
SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS asset,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
         / CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS close
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
GROUP BY CAST(l_shipdate AS DATE), l_returnflag || l_linestatus"""}) + "SELECT * FROM prices")
def scan_date_range(spark, sf):
    """Prices for a date range: the range predicate sits on the scan
    (parquet row-group pruning via PushedFilters) before aggregation."""
    li = read_table(spark, sf, "lineitem").filter(
        (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return A.prices(spark, sf, lineitem=li)


@register("register_local_table", "SELECT * FROM nation")
def register_local_table(spark, sf):
    t = V.register_table(spark, read_table(spark, sf, "nation"), "nation_local")
    assert "nation_local" in V.table_names(spark)
    return t


def _cache_key(sf: str) -> str:
    return hashlib.sha1(sf.encode()).hexdigest()[:16]


@register("compute_or_load", with_("tracks") + "SELECT artist_name, count(*) AS n FROM tracks GROUP BY artist_name")
def compute_or_load(spark, sf):
    """Counts persisted under a key of the input; later calls load them."""
    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vistaframe/cache/artist_counts-{_cache_key(sf)}"
    return FS.compute_or_load(spark, path, lambda: T.value_counts(A.tracks(spark, sf), "artist_name"))


@register("write_predictions_csv", with_("votes") + """
SELECT id AS PassengerId, CAST(p_a > 0.5 AS INT) AS Survived FROM votes""")
def write_predictions_csv(spark, sf):
    """Answer file ``PassengerId,Survived`` written with a header, read back."""
    path = scratch_path(spark, "answers")
    v = A.votes(spark, sf)
    FS.write_csv(v.select(F.col("id").alias("PassengerId"), (F.col("p_a") > 0.5).cast("int").alias("Survived")), path)
    return FS.read_csv(spark, path, "PassengerId BIGINT, Survived INT", header=True)


def _profile_sql() -> str:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    counts = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS non_null FROM lineitem"
                                for i, c in enumerate(cols))
    return f"""
SELECT (SELECT count(*) FROM lineitem) AS n_rows,
  CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS BIGINT) AS n_cols,
  CAST(k.position AS INT) AS position, k.column_name,
  CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(c.data_type) END AS data_type,
  k.non_null
FROM ({counts}) k JOIN information_schema.columns c ON c.table_name = 'lineitem' AND c.column_name = k.column_name"""


@register("profile_schema", _profile_sql())
def profile_schema(spark, sf):
    return T.profile_schema(read_table(spark, sf, "lineitem"))


@register("null_counts", with_("census_null") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM census_null" for c in CENSUS_COLS))
def null_counts(spark, sf):
    return T.null_counts(A.census(spark, sf, sentinel_as_null=True))


@register("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_n(spark, sf):
    return V.head_n(read_table(spark, sf, "orders"), 5, "o_orderkey")


@register("collect_filtered", with_("tracks") + """
SELECT artist_name, title, artist_familiarity FROM tracks WHERE artist_familiarity > 0.9""")
def collect_filtered(spark, sf):
    """Lazy filter; rows are only produced when the caller materialises."""
    t = A.tracks(spark, sf).filter(F.col("artist_familiarity") > 0.9)
    return t.select("artist_name", "title", "artist_familiarity")


@register("select_filter_sort", with_("tracks") + """
SELECT artist_name, release, title, year FROM tracks WHERE year >= 1996 AND year < 1998
ORDER BY artist_name, year DESC, title""")
def select_filter_sort(spark, sf):
    t = A.tracks(spark, sf).select("artist_name", "release", "title", "year")
    return (t.filter((F.col("year") >= 1996) & (F.col("year") < 1998))
             .orderBy("artist_name", F.col("year").desc(), "title"))


@register("select_by_name_rule", with_("tracks") + """
SELECT artist_name, title, duration, artist_familiarity, artist_hotttnesss FROM tracks""")
def select_by_name_rule(spark, sf):
    return V.select_by_rule(A.tracks(spark, sf), contains="TI")


@register("select_by_name_starts", with_("tracks") + "SELECT artist_name, artist_familiarity, artist_hotttnesss FROM tracks")
def select_by_name_starts(spark, sf):
    return V.select_by_rule(A.tracks(spark, sf), starts_with="ARTIST")


@register("select_by_name_matches", with_("tracks") + """
SELECT artist_name, title, artist_familiarity, artist_hotttnesss FROM tracks""")
def select_by_name_matches(spark, sf):
    return V.select_by_rule(A.tracks(spark, sf), matches="ti.?t")


@register("select_by_name_ends", with_("tracks") + "SELECT artist_name, release, title FROM tracks")
def select_by_name_ends(spark, sf):
    return V.select_by_rule(A.tracks(spark, sf), ends_with="E")


@register("drop_columns", with_("census") + """
SELECT id, age, education_num, sex, capital_gain, hours_per_week, income FROM census""")
def drop_columns(spark, sf):
    return A.census(spark, sf).drop("workclass", "race", "native_country")


@register("derive_column", with_("tracks") + """
SELECT title, duration, round(duration / 60, 9) + 0.0 AS duration_minutes FROM tracks""")
def derive_column(spark, sf):
    t = A.tracks(spark, sf).select("title", "duration")
    return t.withColumn("duration_minutes", r6(F.col("duration") / 60, 9))


@register("transmute_residual", with_("predictions") + """
SELECT round(predicted - actual, 6) + 0.0 AS residual FROM predictions""")
def transmute_residual(spark, sf):
    p = A.predictions(spark, sf)
    return p.select(r6(F.col("predicted") - F.col("actual")).alias("residual"))


@register("mutate_residual", with_("predictions") + """
SELECT model, actual, predicted, round(predicted - actual, 6) + 0.0 AS residual FROM predictions""")
def mutate_residual(spark, sf):
    p = A.predictions(spark, sf)
    return p.withColumn("residual", r6(F.col("predicted") - F.col("actual")))


@register("filter_threshold", with_("discourse") + """
SELECT id, discourse_type FROM discourse
WHERE CASE WHEN CAST(len(regexp_extract_all(discourse_text, '\\S+')) AS INT) = predictionstring_len THEN 0 ELSE 1 END = 1""")
def filter_threshold(spark, sf):
    from .aggs import discourse_flags
    return discourse_flags(spark, sf).filter(F.col("len_predict") == 1).select("id", "discourse_type")


@register("filter_by_id", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id = 7")
def filter_by_id(spark, sf):
    return read_table(spark, sf, "documents").filter(F.col("doc_id") == 7).select("doc_id", "lang", "n_chars")


@register("filter_is_null", with_("census_null") + "SELECT id, age, income FROM census_null WHERE workclass IS NULL")
def filter_is_null(spark, sf):
    c = A.census(spark, sf, sentinel_as_null=True)
    return c.filter(F.col("workclass").isNull()).select("id", "age", "income")


WIDE = """SELECT d, max(CASE WHEN asset = 'AF' THEN close END) AS AF, max(CASE WHEN asset = 'AO' THEN close END) AS AO,
  max(CASE WHEN asset = 'NF' THEN close END) AS NF, max(CASE WHEN asset = 'NO' THEN close END) AS "NO",
  max(CASE WHEN asset = 'RF' THEN close END) AS RF, max(CASE WHEN asset = 'RO' THEN close END) AS RO
FROM prices GROUP BY d"""


@register("drop_incomplete", with_("prices", extra={"w": WIDE}) + """
SELECT * FROM w WHERE AF IS NOT NULL AND AO IS NOT NULL AND NF IS NOT NULL AND "NO" IS NOT NULL
  AND RF IS NOT NULL AND RO IS NOT NULL""")
def drop_incomplete(spark, sf):
    return V.drop_incomplete(align_wide(A.prices(spark, sf), A.ASSETS))


@register("all_complete", with_("prices", extra={"w": WIDE}) + """
SELECT bool_and(AF IS NOT NULL AND AO IS NOT NULL AND NF IS NOT NULL AND "NO" IS NOT NULL
  AND RF IS NOT NULL AND RO IS NOT NULL) AS all_complete FROM w""")
def all_complete(spark, sf):
    return V.all_complete(align_wide(A.prices(spark, sf), A.ASSETS))


@register("sql_query", with_("tracks") + "SELECT * FROM tracks WHERE year < 1996 AND duration > 300")
def sql_query(spark, sf):
    """SQL text over a registered view, literals passed as named parameters."""
    A.tracks(spark, sf).createOrReplaceTempView("track_metadata")
    return spark.sql("SELECT * FROM track_metadata WHERE year < :max_year AND duration > :min_duration",
                     args={"max_year": 1996, "min_duration": 300})


@register("distinct_values", with_("tracks") + "SELECT DISTINCT artist_name FROM tracks")
def distinct_values(spark, sf):
    return V.distinct_values(A.tracks(spark, sf), "artist_name")


@register("unpivot_long", with_("prices", extra={"lr": """
SELECT d, asset, CASE WHEN close / lag(close) OVER (PARTITION BY asset ORDER BY d) > 0
  THEN ln(close / lag(close) OVER (PARTITION BY asset ORDER BY d)) END AS r FROM prices""",
  "g": "SELECT DISTINCT d FROM prices", "k": "SELECT DISTINCT asset FROM prices"}) + """
SELECT g.d, k.asset || '_Returns' AS key, round(lr.r, 6) + 0.0 AS value
FROM g CROSS JOIN k LEFT JOIN lr ON lr.d = g.d AND lr.asset = k.asset""")
def unpivot_long(spark, sf):
    """Wide returns table (one column per asset) gathered back to
    ``(d, key, value)`` rows; missing cells stay as NULL values."""
    r = S.log_return(A.prices(spark, sf), out="r").withColumn("asset", F.concat("asset", F.lit("_Returns")))
    names = [f"{a}_Returns" for a in A.ASSETS]
    wide = r.groupBy("d").pivot("asset", names).agg(F.first("r"))
    long = V.unpivot_long(wide, ["d"], names, "key", "value")
    return long.select("d", "key", r6("value").alias("value"))


@register("cast_types", with_("tracks") + """
SELECT title, CAST(year AS DOUBLE) AS year_num, artist_hotttnesss > 0.5 AS is_hot,
  CAST(trunc(duration) AS INT) AS duration_int, CAST(year AS VARCHAR) AS year_str FROM tracks""")
def cast_types(spark, sf):
    t = A.tracks(spark, sf)
    return t.select("title", F.col("year").cast("double").alias("year_num"),
                    (F.col("artist_hotttnesss") > 0.5).alias("is_hot"),
                    F.col("duration").cast("int").alias("duration_int"),
                    F.col("year").cast("string").alias("year_str"))


@register("sort_asc_desc", with_("tracks") + """
SELECT artist_name, round(avg(duration), 6) + 0.0 AS mean_duration FROM tracks GROUP BY artist_name ORDER BY mean_duration""")
def sort_asc_desc(spark, sf):
    """The grouped result ordered ascending (descending is the same call
    with ``desc``); the artist name breaks ties so the order is stable."""
    g = A.tracks(spark, sf).groupBy("artist_name").agg(r6(F.avg("duration")).alias("mean_duration"))
    return g.orderBy("mean_duration", "artist_name")


@register("top_n_ties", with_("tracks", extra={"c": "SELECT title, count(*) AS n FROM tracks GROUP BY title"}) + """
SELECT title, n FROM c WHERE n >= (SELECT min(n) FROM (SELECT n FROM c ORDER BY n DESC LIMIT 20))""")
def top_n_ties(spark, sf):
    counts = T.value_counts(A.tracks(spark, sf), "title")
    return T.top_n_ties(counts, "n", 20)
