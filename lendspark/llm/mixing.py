"""Mix sources to target weights with hash-threshold histograms.

Every row gets a uniform hash.  A source's budget is met by whole copies of the source plus all rows below a hash threshold.  Summing
sizes by (source, leading hash digits) locates the threshold to one bucket; only that bucket is summed again by its next digits, until it
holds one hash.  Budgets nest: a larger budget keeps every row that a smaller one takes.  Rows are then filtered by comparison,
without sorting and independently of partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import empty_text, save

DIGITS = 3  # hex digits a level: 4,096 buckets a source


def cycle_weight(rank: int) -> int:
    """Weights 3, 1, 2, repeating, by the source's place in code point order."""
    return (3, 1, 2)[rank % 3]


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: dict[str | None, int], share: float, most: float, weight: Callable[[int], float]) -> dict[str | None, float]:
    """Budget of each source: ``share`` of all sizes by weight, at most ``most`` times a source's size, the excess reshared.

    The level at which all uncapped sources get level * weight is found in order of cap / weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weight(k) for k, s in enumerate(names)}
    cap = {s: most * sizes[s] for s in names}
    order = sorted(names, key=lambda s: cap[s] / w[s])
    budget, rest, left = share * sum(sizes.values()), sum(w.values()), 0.0
    out = dict(cap)
    for k, s in enumerate(order):
        level = (budget - left) / rest
        if level <= cap[s] / w[s]:
            out.update({t: level * w[t] for t in order[k:]})
            break
        left += cap[s]
        rest -= w[s]
    return out


def row_hash(key: str, text: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), empty_text(text)).cast("binary"))


class Plan:
    """Sizes, targets and thresholds by source."""

    def __init__(self, rows: DataFrame, share: float, most: float, weight: Callable[[int], float]) -> None:
        """``rows``: source, size, h."""
        self.sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
        self.target = targets(self.sizes, share, most, weight)
        self.whole = {s: int(self.target[s] // n) if n else 0 for s, n in self.sizes.items()}
        left = {s: self.target[s] - self.whole[s] * n for s, n in self.sizes.items()}
        prefix, below = dict.fromkeys(self.sizes, ""), dict.fromkeys(self.sizes, 0)
        cut = {s: "" for s, room in left.items() if room <= 0}  # below every hash
        depth = 0
        while len(cut) < len(self.sizes):
            todo = {s: prefix[s] for s in self.sizes if s not in cut}
            found = rows.where(_member(todo, depth)).groupBy("source", F.substring("h", depth + 1, DIGITS).alias("d")).agg(
                F.sum("size").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")).collect()
            by: dict = {s: [] for s in todo}
            for r in found:
                if r["source"] in by:
                    by[r["source"]].append(r)
            for s in todo:
                cut[s] = "g"  # above every hash: all rows of the bucket fit
                for r in sorted(by[s], key=lambda r: r["d"]):
                    after = below[s] + r["n"]
                    if r["low"] == r["high"]:
                        if below[s] + after > 2 * left[s]:
                            cut[s] = r["low"]
                            break
                    elif after > left[s]:
                        prefix[s] += r["d"]  # the threshold lies in this bucket: refine it alone
                        del cut[s]
                        break
                    below[s] = after
                else:
                    if depth:
                        cut[s] = prefix[s] + "g"  # behind the whole bucket
            depth += DIGITS
        self.cut = cut

    def copies(self, source: Column, h: Column) -> Column:
        """How often the mix takes a row."""
        out = F.lit(0)
        for s, cut in self.cut.items():
            out = F.when(source.eqNullSafe(F.lit(s)), F.lit(self.whole[s]) + (h < F.lit(cut)).cast("int")).otherwise(out)
        return out.cast("long")


def _rows(df: DataFrame, text: str, source: str, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(empty_text(text)).alias("size"),
                     row_hash(key, text).alias("h"))


def mix(df: DataFrame, share: float = 1.5, most: float = 2.0, weight: Callable[[int], float] = cycle_weight, text: str = "text",
        source: str = "source", key: str = "doc_id") -> DataFrame:
    """Per row: key, source, size, source_size, target (its source's) and ``copies``, how often the mix takes the row.

    A null text has size 0, an empty one too; a null source is a source of its own, last in order.  Null keys are hashed by text
    alone.  Rows repeated in full share one hash and are taken together; otherwise a row's fate depends on its own hash only.
    The rows at a threshold are taken if that comes nearer to the target.  Extra columns are ignored; an empty table gives none.
    The driver holds one number a source (a mix is specified by source, so that is a configuration's size) and 4,096 sums for
    each while a level is refined.
    """
    rows = save(_rows(df, text, source, key))
    plan = Plan(rows, share, most, weight)
    return rows.select(F.col("key").alias(key), F.col("source").alias(source), "size", _lookup(plan.sizes, "long").alias("source_size"),
                       _lookup(plan.target, "double").alias("target"), plan.copies(F.col("source"), F.col("h")).alias("copies"))


def mixed(df: DataFrame, share: float = 1.5, most: float = 2.0, weight: Callable[[int], float] = cycle_weight, text: str = "text",
          source: str = "source", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that the mix takes, each as often as it is taken, all columns kept; cases as for ``mix``.  No join."""
    plan = Plan(save(_rows(df, text, source, key)), share, most, weight)
    copies = plan.copies(F.col(source), row_hash(key, text))
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode(F.array_repeat(own, copies.cast("int"))).alias("row")).select("row.*")


def _member(prefixes: dict, depth: int) -> Column:
    if depth == 0:
        return F.lit(True)
    out = F.lit(False)
    for s, p in prefixes.items():
        out = out | (F.col("source").eqNullSafe(F.lit(s)) & F.col("h").startswith(p))
    return out


def _lookup(values: dict, kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for s, v in values.items():
        out = F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(v).cast(kind)).otherwise(out)
    return out
