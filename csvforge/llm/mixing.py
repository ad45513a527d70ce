"""Operator 2: mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree domain > language > source.  A token budget goes down the
tree: a node's children share it by their weights, and a child that cannot take its
share (its documents times ``max_epochs``) leaves the rest to its siblings; only
what a whole subtree cannot take reaches the siblings of its ancestors.  Budgets
are whole tokens (divisions round down).

A leaf is read epoch by epoch, each in its own seeded order (md5 of seed, epoch and
document), and takes the longest prefix of whole documents within its budget.

Scale: documents are reduced to one row per leaf by a map-side combined aggregate;
the tree steps are windows over that table (one row per source).  The prefix of a
leaf is found without sorting it: token sums per leaf and leading hash digits are
cumulated, and only the documents of the one digit group in which the budget ends
are refined further, digit by digit, so a leaf with a third of all rows is neither
sorted nor held by one task.  What comes out is one cut rank per leaf and epoch, and
choosing documents is a comparison with it.

Nulls: a null language or source is a leaf of its own (``und``, ``(none)``); a null
text has no tokens; such documents are taken like others of their leaf.  Repeated
rows are documents of their own that stand side by side in the order (ties are
taken or left together).  An empty table, or weights that are all zero, give an
empty mix.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace, free_name, prepare, table

LEVELS = ("domain", "language", "source")
DOMAINS = ("web", "books", "forum", "reference")      # sources are dealt by number
WEIGHTS = {                                           # target weights; 1 where a name is missing
    "domain": {"web": 4, "books": 3, "forum": 2, "reference": 1},
    "language": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
SEED = 20240601
MAX_EPOCHS = 4
SHARE = (1, 1)                                        # budget: this part of the corpus' tokens
DIGITS = 3                                            # hash digits a refining step looks at


def domain_of(source: Column) -> Column:
    """Domain of a source: its number modulo the domains, ``other`` without a number."""
    n = F.regexp_extract(source, r"([0-9]{1,18})$", 1)
    k = F.pmod(n.try_cast("long"), F.lit(len(DOMAINS))).cast("int")
    return F.coalesce(F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), k + 1), F.lit("other"))


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, int(w)).otherwise(out)
    return out.cast("long")


def leaves(df: DataFrame, text: str, key: str, lang: str, source: str, keep=()) -> DataFrame:
    """Every document with its leaf and its tokens (words between white space)."""
    src = F.coalesce(F.col(source).cast("string"), F.lit("(none)"))
    n = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return df.select(F.col(key).alias("doc_id"), domain_of(src).alias("domain"),
                     F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("language"),
                     src.alias("source"), n.alias("n_tokens"), *keep)


def budgets(docs: DataFrame, ws: Workspace, weights: dict, max_epochs: int, share) -> DataFrame:
    """``(domain, language, source, available, budget)`` for every leaf."""
    tree = ws.stage(docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), "tree")
    tree = tree.withColumn("cap", F.col("available") * F.lit(max_epochs))
    every = Window.partitionBy(F.lit(0))                   # the domains, a handful of rows
    total = tree.agg(F.sum("available")).first()[0] or 0
    tree = tree.withColumn("budget", F.lit(total * int(share[0]) // int(share[1])).cast("long"))
    for i, level in enumerate(LEVELS):
        path = list(LEVELS[:i + 1])
        nodes = tree.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first("budget").alias("budget"))
        nodes = nodes.withColumn("w", _weight(level, weights))
        up = Window.partitionBy(*path[:-1]) if i else every
        by = up.orderBy(F.col("cap") / F.col("w"), level).rowsBetween(Window.unboundedPreceding, -1)
        rest = up.orderBy(F.col("cap") / F.col("w"), level).rowsBetween(0, Window.unboundedFollowing)
        nodes = (nodes.where("w > 0")
                 .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(by), F.lit(0)))
                 .withColumn("wsum", F.sum("w").over(rest))
                 .withColumn("full", F.col("cap") * F.col("wsum") <= F.col("w") * F.col("left")))
        short = up.orderBy(F.col("cap") / F.col("w"), level)
        # children up to the first that takes its share are full; the others share what is left
        nodes = nodes.withColumn("open", F.max(F.when(F.col("full"), 0).otherwise(1)).over(
            short.rowsBetween(Window.unboundedPreceding, 0)))
        nodes = nodes.withColumn("level", F.min(F.when(F.col("open") == 1, F.struct(
            F.row_number().over(short).alias("k"), "left", "wsum"))).over(up))
        nodes = nodes.withColumn("given", F.when(F.col("open") == 0, F.col("cap")).otherwise(
            F.expr("w * level.left div level.wsum")))
        tree = tree.drop("budget").join(nodes.select(*path, F.col("given").alias("budget")), path)
    return tree.select(*LEVELS, "available", "budget")


def _order(seed: int, epoch: str = "epoch") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(epoch).cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def cut_ranks(rows: DataFrame, ws: Workspace, digits: int = DIGITS) -> DataFrame:
    """For ``rows`` of ``(leaf, epoch, n_tokens, rank, quota)`` the rank of every leaf and
    epoch at which the running tokens in rank order first exceed the quota.

    Equal ranks stand together: all of them are before the cut or none is."""
    leaf = [*LEVELS, "epoch"]
    state, at = None, 1
    while True:
        last = at > 3 * digits                # ranks that agree in 9 hex digits are few rows
        open_ = rows.withColumn("base", F.lit(0).cast("long")).withColumn("lead", F.lit(""))
        if state is not None:
            open_ = rows.join(state, leaf).where(F.substring("rank", 1, at - 1) == F.col("lead"))
        digit = F.substring("rank", at, 32 if last else digits)
        sums = (open_.groupBy(*leaf, "quota", "base", "lead", digit.alias("digit"))
                .agg(F.sum("n_tokens").alias("t")))
        run = Window.partitionBy(*leaf).orderBy("digit")
        sums = sums.withColumn("upto", F.col("base") + F.sum("t").over(run)).where(F.col("upto") > F.col("quota"))
        first = F.min(F.struct("digit", (F.col("upto") - F.col("t")).alias("base"), "lead"))
        state = sums.groupBy(*leaf).agg(first.alias("f"))
        state = ws.stage(state.select(*leaf, F.col("f.base").alias("base"),
                                      F.concat("f.lead", "f.digit").alias("lead")), f"cut-{at}")
        if last:
            return state.select(*leaf, F.col("lead").alias("cut"))
        at += digits


def thresholds(docs: DataFrame, ws: Workspace, weights: dict = WEIGHTS, max_epochs: int = MAX_EPOCHS,
               share=SHARE, seed: int = SEED) -> DataFrame:
    """``(domain, language, source, epoch, budget, cut)``: one row per leaf and epoch that
    is read; ``cut`` is null where the whole leaf is taken.  Small: leaves, not documents."""
    goal = budgets(docs, ws, weights, max_epochs, share)
    goal = (goal.withColumn("epochs", F.expr(f"""int(least({int(max_epochs)},
                CASE WHEN available = 0 THEN 1 ELSE budget div available + 1 END))"""))
            .withColumn("epoch", F.explode(F.expr("sequence(0, epochs - 1)")))
            .withColumn("quota", F.col("budget") - F.col("epoch") * F.col("available")))
    goal = ws.stage(goal.select(*LEVELS, "epoch", "budget", "quota", "available"), "goals")
    part = docs.join(goal.where("quota < available").select(*LEVELS, "epoch", "quota"), list(LEVELS))
    part = ws.stage(part.select(*LEVELS, "epoch", "quota", "n_tokens", _order(seed).alias("rank")), "partial")
    return (goal.join(cut_ranks(part, ws), [*LEVELS, "epoch"], "left")
            .select(*LEVELS, "epoch", "budget", "cut"))


def choose(rows: DataFrame, limits: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows (with ``doc_id`` and the leaf columns) of every epoch, before the cut."""
    return (rows.join(limits, list(LEVELS))
            .where(F.col("cut").isNull() | (_order(seed) < F.col("cut"))))


def mix_sources(df: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang",
                source: str = "source", **options) -> DataFrame:
    """One row per chosen document and epoch: ``doc_id, domain, language, source, epoch,
    n_tokens`` and the ``budget`` of its leaf."""
    prepare(df.sparkSession)
    ws = Workspace(df.sparkSession, "mixing")
    docs = ws.stage(leaves(df, text, key, lang, source), "leaves")
    limits = thresholds(docs, ws, **options)
    return ws.finish(choose(docs, limits, options.get("seed", SEED))
                     .select("doc_id", *LEVELS, "epoch", "n_tokens", "budget"))


def mixed_rows(df: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang",
               source: str = "source", **options) -> DataFrame:
    """The chosen rows of ``df`` with all their columns, once per epoch.

    The choice is a comparison with the leaf's cut, so texts are not shuffled while the
    table of leaves is small enough for Spark to broadcast by its size."""
    prepare(df.sparkSession)
    ws = Workspace(df.sparkSession, "mixed")
    docs = ws.stage(leaves(df, text, key, lang, source), "leaves")
    limits = ws.stage(thresholds(docs, ws, **options), "limits")
    whole = free_name([*df.columns, *LEVELS, "doc_id"], "__row")
    rows = leaves(df.withColumn(whole, F.struct("*")), text, key, lang, source, keep=[whole])
    return ws.finish(choose(rows, limits, options.get("seed", SEED)).select(f"{whole}.*"))


def op2_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same mix for DuckDB (one window over each leaf and epoch)."""
    def case(level):
        arms = "".join(f" WHEN {level} = '{n}' THEN {w}" for n, w in sorted(WEIGHTS[level].items()))
        return f"CASE{arms} ELSE 1 END" if arms else "1"
    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    parts = [f"""docs AS (SELECT doc_id, coalesce([{domains}][CAST(nullif(regexp_extract(src, '([0-9]{{1,18}})$', 1), '') AS BIGINT) % {len(DOMAINS)} + 1], 'other') AS domain,
  coalesce(lang, 'und') AS language, src AS source, n_tokens
  FROM (SELECT doc_id, lang, coalesce(source, '(none)') AS src,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents)),
t0 AS (SELECT *, available * {MAX_EPOCHS} AS cap, CAST(sum(available) OVER () * {SHARE[0]} // {SHARE[1]} AS BIGINT) AS budget FROM
  (SELECT domain, language, source, CAST(sum(n_tokens) AS BIGINT) AS available FROM docs GROUP BY ALL))"""]
    for i, level in enumerate(LEVELS):
        path, up = ", ".join(LEVELS[:i + 1]), ", ".join(LEVELS[:i])
        part = f"PARTITION BY {up}" if up else ""
        order = f"ORDER BY cap / w, {level}"
        parts.append(f"""n{i} AS (SELECT *, {case(level)} AS w FROM
  (SELECT {path}, CAST(sum(cap) AS BIGINT) AS cap, first(budget) AS budget FROM t{i} GROUP BY {path})),
a{i} AS (SELECT *, budget - coalesce(sum(cap) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
  sum(w) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wsum,
  row_number() OVER ({part} {order}) AS k FROM n{i} WHERE w > 0),
b{i} AS (SELECT *, max(CASE WHEN cap * wsum <= w * lft THEN 0 ELSE 1 END) OVER ({part} ORDER BY k) AS open FROM a{i}),
c{i} AS (SELECT *, min(CASE WHEN open = 1 THEN k END) OVER ({part}) AS k0 FROM b{i}),
d{i} AS (SELECT x.*, CAST(CASE WHEN x.open = 0 THEN x.cap ELSE x.w * y.lft // y.wsum END AS BIGINT) AS given
  FROM c{i} x LEFT JOIN c{i} y ON x.k0 = y.k{''.join(f' AND x.{c} = y.{c}' for c in LEVELS[:i])}),
t{i + 1} AS (SELECT t.* REPLACE (d.given AS budget) FROM t{i} t JOIN d{i} d USING ({path}))""")
    return "WITH " + ",\n".join(parts) + f""",
e AS (SELECT d.*, available, budget, unnest(generate_series(0, least({MAX_EPOCHS}, CASE WHEN available = 0 THEN 1 ELSE budget // available + 1 END) - 1)) AS epoch
  FROM docs d JOIN t{len(LEVELS)} USING (domain, language, source)),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, source, epoch
  ORDER BY md5('{SEED}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS upto FROM e)
SELECT doc_id, domain, language, source, CAST(epoch AS INTEGER) AS epoch, n_tokens, budget
FROM r WHERE upto <= budget - epoch * available"""


QUERIES = {"op2_mixing_sources": op2_mixing_sources}
SQL = {"op2_mixing_sources": _sql()}
