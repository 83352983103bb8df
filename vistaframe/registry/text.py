"""Scalar / text queries: recodes, counts, regex filters, extraction, formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.html import Rule
from ..oracle import with_
from ..operators import joins as J
from ..operators import stats as T
from ..operators import text as TX
from ..plans import adapters as A
from ..sources.tables import read_table
from ._base import r6, register
from .joins import delta_sql

# Category lists of the census recodes.
GOV_JOBS = ["Local-gov", "State-gov", "Federal-gov"]
SELF_EMP_JOBS = ["Self-emp-not-inc", "Self-emp-inc"]
HOME_COUNTRY = "UNITED STATES"
SEX_CODES = {"Male": 1, "Female": 0}
INCOME_CODES = {">50K": 1, "<=50K": 0}
BLACKLIST = ["USER-1$", "USER-7$"]

RECODES = """CASE WHEN workclass = 'Private' THEN 0 WHEN workclass IN ('Local-gov', 'State-gov', 'Federal-gov') THEN 1
  WHEN workclass IN ('Self-emp-not-inc', 'Self-emp-inc') THEN 2 ELSE 3 END AS workclass_cat,
  CASE WHEN race = 'White' THEN 0 WHEN race = 'Black' THEN 1 ELSE 2 END AS race_cat,
  CASE WHEN native_country = 'UNITED STATES' THEN 1 ELSE 0 END AS from_us"""


def recodes():
    return [X.recode_cascade("workclass", [(SELF_EMP_JOBS, 2), (GOV_JOBS, 1), (["Private"], 0)], 3).alias("workclass_cat"),
            X.recode_cascade("race", [(["Black"], 1), (["White"], 0)], 2).alias("race_cat"),
            X.recode_cascade("native_country", [([HOME_COUNTRY], 1)], 0).alias("from_us")]


@register("recode_case", with_("census_null") + f"SELECT id, {RECODES} FROM census_null")
def recode_case(spark, sf):
    c = A.census(spark, sf, sentinel_as_null=True)
    return c.select("id", *recodes())


@register("recode_map", with_("census") + """
SELECT id, CASE sex WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS sex,
  CASE income WHEN '>50K' THEN 1 WHEN '<=50K' THEN 0 END AS income FROM census""")
def recode_map(spark, sf):
    c = A.census(spark, sf)
    return c.select("id", X.recode_map("sex", SEX_CODES).alias("sex"), X.recode_map("income", INCOME_CODES).alias("income"))


@register("census_etl", with_("census_null") + f"""
SELECT id, age, education_num, CASE sex WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS sex,
  round(capital_gain, 6) + 0.0 AS capital_gain, hours_per_week,
  CASE income WHEN '>50K' THEN 1 WHEN '<=50K' THEN 0 END AS income, {RECODES} FROM census_null""")
def census_etl(spark, sf):
    """The whole load-and-clean step as ONE projection over the scan:
    sentinel -> NULL, category recodes, code maps, dropped columns."""
    c = A.census(spark, sf, sentinel_as_null=True)
    return c.select("id", "age", "education_num", X.recode_map("sex", SEX_CODES).alias("sex"),
                    r6("capital_gain").alias("capital_gain"), "hours_per_week",
                    X.recode_map("income", INCOME_CODES).alias("income"), *recodes())


@register("word_count", "SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INT) AS n_words FROM documents")
def word_count(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", X.word_count("text").alias("n_words"))


@register("length_mismatch_flag", with_("discourse") + """
SELECT id, CAST(len(regexp_extract_all(discourse_text, '\\S+')) AS INT) AS discourse_len, predictionstring_len,
  CASE WHEN CAST(len(regexp_extract_all(discourse_text, '\\S+')) AS INT) = predictionstring_len THEN 0 ELSE 1 END AS len_predict
FROM discourse""")
def length_mismatch_flag(spark, sf):
    from .aggs import discourse_flags
    return discourse_flags(spark, sf).select("id", "discourse_len", "predictionstring_len", "len_predict")


@register("regex_blacklist", with_("snapshots") + """
SELECT site, snapshot, item FROM snapshots WHERE item IS NOT NULL AND NOT regexp_matches(item, '(?i)USER-1$|USER-7$')""")
def regex_blacklist(spark, sf):
    s = A.snapshots(spark, sf).filter(F.col("item").isNotNull())
    return s.filter(~X.matches_any("item", BLACKLIST, case_insensitive=True))


AD = r'<div class="ad">(.*?)</div>'
LINK = r'<li><a href="[^"]*">(.*?)</a></li>'


@register("extract_elements", f"""
SELECT page_id, 'ad' AS kind, unnest(regexp_extract_all(html, '{AD}', 1)) AS element FROM pages
UNION ALL SELECT page_id, 'link', unnest(regexp_extract_all(html, '{LINK}', 1)) FROM pages""")
def extract_elements(spark, sf):
    p = read_table(spark, sf, "pages")
    ads = TX.extract_elements(p, "html", AD, keep=["page_id", F.lit("ad").alias("kind")])
    links = TX.extract_elements(p, "html", LINK, keep=["page_id", F.lit("link").alias("kind")])
    return ads.unionByName(links)


ELEMENTS = [Rule("ad", "div", cls="ad"), Rule("link", "a", parent="li")]


@register("select_elements", f"""
SELECT page_id, 'ad' AS kind, unnest(regexp_extract_all(html, '(?s){AD}', 1)) AS element FROM pages
UNION ALL SELECT page_id, 'link', unnest(regexp_extract_all(html, '(?s){LINK}', 1)) FROM pages""")
def select_elements(spark, sf):
    """``extract_elements`` by tag, class and parent instead of a pattern; elements
    of several lines, which the pattern there misses, are among them."""
    p = TX.select_elements(read_table(spark, sf, "pages"), "html", ELEMENTS, keep=["page_id"])
    return p.select("page_id", "kind", "element")


@register("math_functions", with_("prices") + """
SELECT d, asset, round(ln(close), 6) + 0.0 AS ln_close, round(sqrt(close), 6) + 0.0 AS sqrt_close,
  CAST(ceil(close) AS BIGINT) AS ceil_close, round_even(ln(close), 4) + 0.0 AS ln_close_4,
  round(abs(close - 50000), 6) + 0.0 AS abs_dev, CAST(sign(close - 50000) AS DOUBLE) AS sign_dev,
  round(power(ln(close), 2), 6) + 0.0 AS sq_ln FROM prices""")
def math_functions(spark, sf):
    p = A.prices(spark, sf)
    c = F.col("close")
    return p.select("d", "asset", r6(F.ln(c)).alias("ln_close"), r6(F.sqrt(c)).alias("sqrt_close"),
                    F.ceil(c).cast("bigint").alias("ceil_close"), (X.half_even(F.ln(c), 4) + 0.0).alias("ln_close_4"),
                    r6(F.abs(c - 50000)).alias("abs_dev"), F.signum(c - 50000).alias("sign_dev"),
                    r6(F.pow(F.ln(c), 2)).alias("sq_ln"))


@register("param_axes", with_("prices", extra={"mm": "SELECT asset, min(close) AS lo, max(close) AS hi FROM prices GROUP BY asset"}) + """
SELECT asset, 'lin' AS axis, CAST(i AS INT) AS i,
  round(CASE WHEN i = 5 THEN hi ELSE lo + i * ((hi - lo) / 5) END, 6) + 0.0 AS value
FROM mm, (SELECT unnest(generate_series(0, 5)) AS i)
UNION ALL
SELECT asset, 'log', CAST(i AS INT), round(pow(10, CASE WHEN i = 14 THEN log10(hi) ELSE log10(lo) + i * ((log10(hi) - log10(lo)) / 14) END), 6) + 0.0
FROM mm, (SELECT unnest(generate_series(0, 14)) AS i)""")
def param_axes(spark, sf):
    """Linear (6 points) and log (15 points) axes spanning each asset's price
    range, as parameter grids are built."""
    mm = A.prices(spark, sf).groupBy("asset").agg(F.min("close").alias("lo"), F.max("close").alias("hi"))
    lin = mm.select("asset", F.lit("lin").alias("axis"),
                    F.posexplode(X.linspace(F.col("lo"), F.col("hi"), 6)).alias("i", "value"))
    log = mm.select("asset", F.lit("log").alias("axis"),
                    F.posexplode(X.logspace(F.log10("lo"), F.log10("hi"), 15)).alias("i", "value"))
    return lin.unionByName(log).select("asset", "axis", "i", r6("value").alias("value"))


@register("concat_items", delta_sql(True) + """
SELECT site, snapshot, site || ' update! ' || array_to_string(list_sort(list(item)), ', ') AS message
FROM delta GROUP BY site, snapshot""")
def concat_items(spark, sf):
    d = J.anti_join_previous(A.snapshots(spark, sf), skip_empty=True)
    return d.groupBy("site", "snapshot").agg(X.alert_text(F.col("site"), F.collect_list("item")).alias("message"))


@register("format_report", """
SELECT l_returnflag || l_linestatus AS asset,
  printf('%s : revenue $%.2f, last shipment %s', l_returnflag || l_linestatus,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100,
         strftime(max(l_shipdate), '%d/%m/%Y %H:%M:%S')) AS line
FROM lineitem GROUP BY l_returnflag || l_linestatus""")
def format_report(spark, sf):
    li = read_table(spark, sf, "lineitem")
    g = li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("asset")).agg(
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).cast("double") / 100).alias("rev"),
        F.max("l_shipdate").alias("last"))
    return g.select("asset", F.format_string("%s : revenue %s, last shipment %s", F.col("asset"),
                                             X.money("rev"), X.stamp("last")).alias("line"))


@register("char_positions", """
SELECT n_nationkey, CAST(i - 1 AS INT) AS pos, substr(n_name, i, 1) AS ch,
  CAST(instr(n_name, substr(n_name, i, 1)) - 1 AS INT) AS first_index
FROM nation, (SELECT unnest(generate_series(1, 40)) AS i) WHERE i <= length(n_name)""")
def char_positions(spark, sf):
    n = read_table(spark, sf, "nation")
    return TX.char_first_positions(n, "n_name", keep=["n_nationkey"])


TOKCLASS = "CASE " + " ".join(f"WHEN regexp_matches(tok, '{rx}') THEN '{name}'" for name, rx in TX.TOKEN_CLASSES) + \
    f" ELSE '{TX.OTHER_CLASS}' END"


CLASS_COUNTS = f"""SELECT discourse_type, {TOKCLASS} AS token_class, count(*) AS n
FROM (SELECT discourse_type, unnest(regexp_extract_all(discourse_text, '\\S+')) AS tok FROM discourse)
GROUP BY ALL"""


@register("token_class_counts", with_("discourse") + CLASS_COUNTS)
def token_class_counts(spark, sf):
    return TX.token_counts(A.discourse(spark, sf), "discourse_type", "discourse_text")


def _top9_sql(counts: str, token: str) -> str:
    """The 9 largest per group and what they leave."""
    kept = f"""SELECT discourse_type, CASE WHEN rk <= 9 THEN {token} ELSE 'Other' END AS {token}, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT *, row_number() OVER (PARTITION BY discourse_type ORDER BY n DESC, {token}) AS rk FROM {counts}) GROUP BY ALL"""
    return f"""SELECT t.discourse_type, t.{token}, coalesce(x.n, 0) AS n, round(coalesce(x.n, 0) / tot, 4) AS share
FROM (SELECT DISTINCT discourse_type, {token} FROM ({kept}) UNION SELECT DISTINCT discourse_type, 'Other' FROM {counts}) t
LEFT JOIN ({kept}) x ON x.discourse_type = t.discourse_type AND x.{token} = t.{token}
JOIN (SELECT discourse_type, sum(n) AS tot FROM {counts} GROUP BY ALL) s ON s.discourse_type = t.discourse_type"""


def _pivot_sql(token: str) -> str:
    shares = ", ".join(f"max(CASE WHEN discourse_type = '{v}' THEN share END) AS {v}" for v in A.LANGS)
    return f"SELECT {token}, {shares} FROM t9 GROUP BY {token}"


WC = """SELECT discourse_type, token, count(*) AS n FROM (
  SELECT discourse_type, unnest(regexp_extract_all(discourse_text, '\\S+')) AS token FROM discourse) GROUP BY ALL"""


def _top9_classes(spark, sf):
    return T.top_n_with_other(token_class_counts(spark, sf), "discourse_type", "token_class", "n", top=9)


def _top9_tokens(spark, sf):
    wc = TX.word_counts(A.discourse(spark, sf), "discourse_type", "discourse_text")
    return T.top_n_with_other(wc, "discourse_type", "token", "n", top=9)


@register("top_n_with_other", with_("discourse", extra={"cc": CLASS_COUNTS}) + _top9_sql("cc", "token_class"))
def top_n_with_other(spark, sf):
    return _top9_classes(spark, sf)


@register("pivot_shares", with_("discourse", extra={"cc": CLASS_COUNTS, "t9": _top9_sql("cc", "token_class")}) + _pivot_sql("token_class"))
def pivot_shares(spark, sf):
    return T.pivot_wide(_top9_classes(spark, sf), "token_class", "discourse_type", "share", A.LANGS)


@register("top_n_tokens_with_other", with_("discourse", extra={"wc": WC}) + _top9_sql("wc", "token"))
def top_n_tokens_with_other(spark, sf):
    """The same over raw tokens: very many per group."""
    return _top9_tokens(spark, sf)


@register("pivot_token_shares", with_("discourse", extra={"wc": WC, "t9": _top9_sql("wc", "token")}) + _pivot_sql("token"))
def pivot_token_shares(spark, sf):
    return T.pivot_wide(_top9_tokens(spark, sf), "token", "discourse_type", "share", A.LANGS)
