"""Text operators: tokens, a regex token tagger, element extraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..functions.html import Rule, elements

# Fixed token classes of the built-in tagger, tested in this order.
TOKEN_CLASSES = [
    ("NUM", r"^[0-9]+([.,][0-9]+)*\p{P}*$"),
    ("PUNCT", r"^[^\p{L}\p{N}]+$"),
    ("UPPER", r"^\p{Lu}{2,}\p{P}*$"),
    ("CAP", r"^\p{Lu}"),
    ("WORD_PUNCT", r"^\p{L}+\p{P}+$"),
    ("WORD", r"^\p{L}+$"),
]
OTHER_CLASS = "X"


def tokens(text) -> Column:
    """Whitespace tokens of a text (array<string>)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(r"\S+"), 0)


def token_class(tok: Column) -> Column:
    expr = None
    for name, rx in TOKEN_CLASSES:
        cond = tok.rlike(rx)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_CLASS))


def token_counts(df: DataFrame, group: str, text: str, tagger=None, out: str = "token_class") -> DataFrame:
    """Token-category counts per group. ``tagger`` maps a token column to a
    category column; default is the regex tagger above (JVM side). A user
    tagger may be a ``pandas_udf`` (Arrow batches)."""
    tag = tagger or token_class
    # count distinct tokens first (map-side partial aggregation), then tag
    # each distinct token once instead of every occurrence
    wc = word_counts(df, group, text)
    return wc.groupBy(group, tag(F.col("token")).alias(out)).agg(F.sum("n").cast("bigint").alias("n"))


def word_counts(df: DataFrame, group: str, text: str) -> DataFrame:
    """Occurrences of every token per group."""
    toks = df.select(group, F.explode(tokens(text)).alias("token"))
    return toks.groupBy(group, "token").agg(F.count(F.lit(1)).alias("n"))


def extract_elements(df: DataFrame, html: str, pattern: str, out: str = "element", keep=()) -> DataFrame:
    """One row per match of ``pattern`` (first capture group) in the html."""
    return df.select(*keep, F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), 1)).alias(out))


def select_elements(df: DataFrame, page: str, rules: list[Rule], keep=()) -> DataFrame:
    """One row per element of the page that a rule names: the ``keep`` columns,
    ``kind, ord`` (place among the page's named elements), ``element`` (inner
    HTML) and ``text``. Nested and malformed pages are read as they stand (see
    ``functions.html``); a null page has no elements. Rows stay where they are:
    no shuffle."""
    base = df.select(*keep, F.col(page).alias("__page"))
    kept = len(base.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for k, text in enumerate(batch.column(kept)):
                for n, e in enumerate(elements(text.as_py() or "", rules)):
                    rows.append(k)
                    out.append((n, *e))
            taken = batch.select(range(kept)).take(pa.array(rows, pa.int64()))
            kinds = [pa.array([o[i] for o in out], t) for i, t in ((1, pa.string()), (0, pa.int32()), (2, pa.string()), (3, pa.string()))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *kinds], names=names)

    schema = StructType(base.schema.fields[:kept])
    for name, kind in (("kind", StringType()), ("ord", IntegerType()), ("element", StringType()), ("text", StringType())):
        schema = schema.add(name, kind)
    names = schema.fieldNames()
    return base.mapInArrow(run, schema)


def char_first_positions(df: DataFrame, text: str, keep=()) -> DataFrame:
    """For every character position, the 0-based index of the first
    occurrence of that character in the string."""
    chars = df.select(*keep, F.col(text), F.posexplode(F.split(F.col(text), "")).alias("pos", "ch"))
    chars = chars.filter(F.col("pos") < F.length(F.col(text)))
    return chars.select(*keep, "pos", "ch", (F.instr(F.col(text), F.col("ch")) - 1).alias("first_index"))
