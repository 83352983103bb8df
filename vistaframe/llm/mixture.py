"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic). The cells' token sums
are raked until their marginals are the targets; a cell's calibrated over its
observed tokens is its weight, and a document is kept with a probability in
proportion to its cell's weight, decided by a hash of its id and text. Without
``token_share`` the largest weight has probability 1: the expected tokens have
the target marginals, and no larger sample without repeats has; but one rare
category can make that sample small. With ``token_share`` the sample is to hold
this share of all tokens: probabilities are scaled up to it and end at 1, so a
scarce category is kept whole and the others fill the budget in proportion to
their weights. ``reached`` reports where that misses a target.

Targets are shares of named categories, where ``"*"`` stands for all others
together and without it the others keep the share they have; or a power: then
every category in the data gets a share in proportion to that power of its own.
The topic of a document is the one of a few
topic words that it holds most often (of each language the most widespread
words below a share, counted over all documents; a word counts for the language
that holds it most often), else "none"; topics get shares in proportion to a
power of their own. The cells that hold documents are a table; up to CELLS of
them are raked in memory and sent to all tasks, more by grouped sums and joins.

Defined cases: null and empty texts have weight of one token and no topic; a
null source or language is ``"*"``, one of the others; a named category without
documents hands its share to the rest; rows repeated with id and text are kept
or dropped together; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

OTHER, NO_TOPIC = "*", "none"
SPACE = r"[\x20\x09-\x0D]+"
SOURCE_TARGETS, LANG_TARGETS = 0.7, 0.9  # powers: large sources shrink, small ones grow
CELLS = 50_000  # rows of a table that may go to the driver and to all tasks
TOKEN_SHARE = 0.6  # of all tokens, the budget of the query and the pipeline
TOPIC_WORDS, TOPIC_POWER = 2, 0.9  # words a language, power of the topics' own shares
TOPIC_CHARS, TOPIC_SHARE = 5, 0.2  # at least so long, in at most this share of the documents


AXES = ("s", "l", "t")
ROUNDS, TOLERANCE = 200, 1e-10


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SPACE), "")


def _small(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= CELLS else table


def topic_words(texts: DataFrame, per_group: int = TOPIC_WORDS) -> list[str]:
    """Per language (column ``l``) the words held by the most documents, among those that are long enough,
    in at most TOPIC_SHARE of the language's documents and in no other language in more documents."""
    sizes = materialise(texts.groupBy("l").agg(F.count("*").alias("docs")), "topic_sizes")
    pairs = texts.select("l", F.explode(F.array_distinct("words")).alias("word"))
    held = materialise(pairs.filter(F.char_length("word") >= TOPIC_CHARS).groupBy("l", "word").count(), "topic_words")
    some = held.join(_small(sizes), "l").filter(F.col("count") <= TOPIC_SHARE * F.col("docs"))
    order = F.struct(-F.col("count"), "l")
    own = some.groupBy("word").agg(F.min_by("l", order).alias("l"), F.max("count").alias("n"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.col("n").desc(), "word"))
    first = own.withColumn("rank", rank).filter(F.col("rank") <= per_group)
    return [r["word"] for r in sorted(first.collect(), key=lambda r: (r["l"], r["rank"]))]


def _fit(cells: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """``rake`` over a list of cells, with the category of each on every axis."""
    fitted = cells / cells.sum() if cells.sum() else cells.astype(float)
    for _ in range(ROUNDS):
        worst = 0.0
        for at, target in zip(places, targets):
            now = np.bincount(at, fitted, len(target)).astype(float)
            factor = np.divide(target, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(now - target)[now > 0].max(initial=0.0)))
            fitted = fitted * factor[at]
        if worst < TOLERANCE:
            break
    return fitted


def rake(cells: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Scale the cells until the sums along each axis are the targets (as shares)."""
    places = [at.ravel() for at in np.indices(cells.shape)]
    return _fit(cells.ravel(), places, targets).reshape(cells.shape)


def _shares(observed: np.ndarray, names: list[str], targets: dict[str, float] | float) -> np.ndarray:
    """Target shares of the categories that have tokens; ``names`` ends with the others."""
    own = observed / max(observed.sum(), 1e-300)
    if not isinstance(targets, dict):
        wanted = own ** targets * (own > 0)
        return wanted / max(wanted.sum(), 1e-300)
    wanted = np.array([targets.get(n, 0.0) for n in names])
    if OTHER not in targets:  # the others keep what they have
        wanted[-1] = 0.0
        wanted = wanted / max(wanted[observed > 0].sum(), 1e-300) * (1 - own[-1])
        wanted[-1] = own[-1]
    wanted = np.where(observed > 0, wanted, 0.0)
    return wanted / wanted.sum() if wanted.sum() else own


def _category(column: Column, targets: dict[str, float] | float) -> Column:
    """The value, or the others where only some are named."""
    value = F.coalesce(column, F.lit(OTHER))
    return F.when(value.isin(list(targets)), value).otherwise(OTHER) if isinstance(targets, dict) else value


def _axis(sums: dict[str, float], targets: dict[str, float] | float) -> tuple[list[str], np.ndarray]:
    """Categories of an axis, the others at the end, and their target shares."""
    names = [*sorted(({*sums} | ({*targets} if isinstance(targets, dict) else set())) - {OTHER}), OTHER]
    return names, _shares(np.array([float(sums.get(n, 0)) for n in names]), names, targets)


def _scale(sums: Callable[[float], tuple[float, float]], budget: float) -> float:
    """s with sum over cells of tokens x min(1, s x weight) = budget, or all cells that have a weight kept whole.
    ``sums(s)``: tokens of the cells with s x weight >= 1, weight x tokens of the others."""
    scale = 0.0
    while True:
        whole, rest = sums(scale)
        if rest <= 0 or (budget - whole) / rest <= scale * (1 + 1e-12):
            return scale
        scale = (budget - whole) / rest


def _weights_in_memory(cells: DataFrame, targets: list, token_share: float | None = None) -> DataFrame:
    rows = sorted(tuple(r) for r in cells.select(*AXES, "n").collect())
    tokens = np.array([r[3] for r in rows], float)
    places, shares = [], []
    for k, target in enumerate(targets):
        sums: dict[str, float] = {}
        for r in rows:
            sums[r[k]] = sums.get(r[k], 0) + r[3]
        names, share = _axis(sums, target)
        place = {n: i for i, n in enumerate(names)}
        places.append(np.array([place[r[k]] for r in rows], int))
        shares.append(share)
    weight = _fit(tokens, places, shares) * tokens.sum() / tokens
    scale = 1.0 / max(weight.max(initial=0.0), 1e-300)
    if token_share is not None:
        scale = _scale(lambda s: (tokens[s * weight >= 1].sum(), (weight * tokens)[s * weight < 1].sum()), token_share * tokens.sum())
    chance = np.minimum(weight * scale, 1.0)
    return F.broadcast(cells.sparkSession.createDataFrame(
        [(*r[:3], w, c) for r, w, c in zip(rows, weight.tolist(), chance.tolist())],
        "s string, l string, t string, weight double, probability double"))


def _weights_by_joins(cells: DataFrame, targets: list, token_share: float | None = None) -> DataFrame:
    """The same by grouped sums and joins, written once a round."""
    spark, total = cells.sparkSession, cells.agg(F.sum("n")).first()[0]
    goals = []
    for c, target in zip(AXES, targets):
        sums = cells.groupBy(c).agg(F.sum("n").alias("n"))
        if isinstance(target, dict):  # a row per named category
            names, share = _axis({r[c]: r["n"] for r in sums.collect()}, target)
            goal = spark.createDataFrame(list(zip(names, share.tolist())), f"{c} string, goal double")
        else:
            own = sums.select(c, F.pow(F.col("n") / F.lit(total), F.lit(float(target))).alias("p"))
            goal = own.select(c, (F.col("p") / F.lit(own.agg(F.sum("p")).first()[0])).alias("goal"))
        goals.append(goal.checkpoint())
    fitted = cells.select(*AXES, "n", (F.col("n") / F.lit(total)).alias("f"))
    for _ in range(ROUNDS):
        worst = 0.0
        for c, goal in zip(AXES, goals):
            held = F.col("now") > 0
            now = (fitted.groupBy(c).agg(F.sum("f").alias("now")).join(goal, c)
                   .select(c, F.when(held, F.try_divide("goal", "now")).otherwise(1.0).alias("factor"),
                           F.when(held, F.abs(F.col("now") - F.col("goal"))).otherwise(0.0).alias("gap"))).checkpoint()
            worst = max(worst, now.agg(F.max("gap")).first()[0])
            fitted = fitted.join(_small(now.select(c, "factor")), c).select(*AXES, "n", (F.col("f") * F.col("factor")).alias("f"))
        fitted = fitted.checkpoint()
        if worst < TOLERANCE:
            break
    weighed = fitted.select(*AXES, "n", (F.col("f") * F.lit(float(total)) / F.col("n")).alias("weight")).checkpoint()

    def sums(s: float) -> tuple[float, float]:
        whole = F.col("weight") * F.lit(float(s)) >= 1
        row = weighed.agg(F.sum(F.when(whole, F.col("n"))), F.sum(F.when(~whole, F.col("n") * F.col("weight")))).first()
        return float(row[0] or 0), float(row[1] or 0)

    if token_share is None:
        scale = 1.0 / max(weighed.agg(F.max("weight")).first()[0], 1e-300)
    else:
        scale = _scale(sums, token_share * total)
    return weighed.select(*AXES, "weight", F.least(F.col("weight") * F.lit(scale), F.lit(1.0)).alias("probability")).checkpoint()


def calibrate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              lang_col: str = "lang", source_targets: dict | float = SOURCE_TARGETS, lang_targets: dict | float = LANG_TARGETS,
              topic_words_each: int = TOPIC_WORDS, topic_power: float = TOPIC_POWER, seed: int = 5, token_share: float | None = None,
              with_rows: bool = False) -> tuple[DataFrame, list[str]]:
    """(per row ``doc_id, source_group, lang_group, topic, tokens, weight,
    probability, sampled``; the topic words). ``with_rows`` adds the rows of
    ``docs`` as a struct ``_all``; without it, texts are cut into words once
    for the cells and the result."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_all"), docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       docs[source_col].cast("string").alias("source"), docs[lang_col].cast("string").alias("lang"))
    rows = rows.withColumn("words", _words(F.col("text")))
    rows = rows.withColumn("tokens", F.greatest(F.size("words"), F.lit(1)).cast("long"))
    rows = (rows.withColumn("s", _category(F.col("source"), source_targets))
            .withColumn("l", _category(F.col("lang"), lang_targets)))
    chosen = topic_words(rows.select("words", "l"), topic_words_each)
    # the word held most often, of several the first
    hits = F.filter("words", lambda w: w.isin(chosen))
    often = F.transform(F.array_distinct("hits"), lambda w: F.struct(
        F.size(F.filter("hits", lambda h: h == w)).alias("n"), (-F.array_position(F.lit(chosen or [""]), w)).alias("at"), w.alias("word")))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    celled = (rows.withColumn("hits", hits)
              .select("_all", "doc_id", "tokens", draw.alias("draw"), "s", "l",
                      F.coalesce(F.array_max(often)["word"], F.lit(NO_TOPIC)).alias("t")))
    if not with_rows:
        celled = materialise(celled.drop("_all"), "mixture_cells")
    cells = materialise(celled.groupBy(*AXES).agg(F.sum("tokens").alias("n")), "mixture_sums")
    rake_cells = _weights_in_memory if cells.count() <= CELLS else _weights_by_joins
    weights = rake_cells(cells, [source_targets, lang_targets, topic_power], token_share)
    out = celled.join(weights, list(AXES)).withColumn("sampled", F.col("draw") < F.col("probability"))
    return out.select(*(["_all"] if with_rows else []), "doc_id", F.col("s").alias("source_group"), F.col("l").alias("lang_group"),
                      F.col("t").alias("topic"), "tokens", "weight", "probability", "sampled"), chosen


def reached(calibrated: DataFrame) -> DataFrame:
    """Per axis and category of a calibrated table: its target share of the tokens and the share that the sample is
    expected to hold (both null where nothing has a weight)."""
    axes = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(c).alias("category"))
                     for a, c in (("source", "source_group"), ("lang", "lang_group"), ("topic", "topic"))])
    sums = (calibrated.select(F.explode(axes).alias("_at"), "tokens", "weight", "probability")
            .groupBy("_at.axis", "_at.category")
            .agg(F.sum(F.col("tokens") * F.col("weight")).alias("wanted"), F.sum(F.col("tokens") * F.col("probability")).alias("kept")))
    every = Window.partitionBy("axis")
    return sums.select("axis", "category", F.try_divide("wanted", F.sum("wanted").over(every)).alias("target"),
                       F.try_divide("kept", F.sum("kept").over(every)).alias("expected"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, all columns."""
    return calibrate(docs, with_rows=True, **options)[0].filter("sampled").select("_all.*")
