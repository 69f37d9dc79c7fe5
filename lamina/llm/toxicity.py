"""Toxicity by two Kneser-Ney models of letters, one of toxic and one of ordinary texts.

Each model gives the probability of a letter after the letters before it in its word. The highest order is learned from how
often an expression occurs, lower ones from how many different letters it continues, and what is left
of each order by the discount goes to the next lower one. The last order is shared: it counts the continuations of both
classes, so that expressions which neither class knows well tell nothing. A text's score compares its
log-likelihoods under both models, divided by its length.

Models are fitted on as many rows of either class, ``SAMPLE`` at most, so that neither has more
evidence behind it. An expression counts once per text. What difference makes a text toxic is learned from the same rows: each
quarter is judged by models of the other three, and a logistic curve is fitted to that.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lamina.llm.common import small_batches, stash, worker_cache

# Rows of either class that the models are fitted on at most, letters of an expression, the discount, and the parts that
# are judged by models of the others.
SAMPLE = 8_192
ORDER = 5
DISCOUNT = 0.75
FOLDS = 4

# Characters of a text that are cut into words at a time; words, and letters of them, whose value a worker remembers.
PIECE = 1 << 20
REMEMBERED = 200_000
LONGEST = 64


def _words(text: str) -> Iterator[str]:
    """Runs of letters of the lower-cased text; a run that passes the end of a piece ends there if no other ends in reach."""
    import re

    letters = re.compile(r"[^\W\d_]+")
    gap = re.compile(r"[\W\d_]").search
    begin = 0
    while begin < len(text):
        end = begin + PIECE
        found = gap(text, end, end + PIECE) if end < len(text) else None
        end = found.start() if found else end
        yield from letters.findall(text[begin:end].lower())
        begin = end


def _expressions(word: str, order: int) -> Iterator[str]:
    """All expressions of up to ``order`` letters that end in a letter of the word or in its end."""
    line = f" {word} "
    for i in range(1, len(line)):
        for k in range(min(order, i + 1)):
            yield line[i - k : i + 1]


class Pair:
    """Both models, from ``counts``: of each expression its number in ordinary and in toxic texts."""

    def __init__(self, counts: dict[str, tuple[int, int]], order: int = ORDER, discount: float = DISCOUNT):
        self.order = order
        self.known: dict[str, float] = {}
        shared: dict[str, int] = {}
        self.classes = []
        for side in (0, 1):
            # Counts of the highest order and of those that begin a word, which no letter precedes.
            top = {e: c[side] for e, c in counts.items() if c[side] and (len(e) == order or e[0] == " ")}
            continued: dict[str, int] = {}
            for e, c in counts.items():
                if c[side] and 2 < len(e) <= order and e[1] != " ":
                    continued[e[1:]] = continued.get(e[1:], 0) + 1
            number = {**continued, **top}
            total: dict[str, float] = {}
            left: dict[str, float] = {}
            for e, n in number.items():
                if len(e) > 1:
                    total[e[:-1]] = total.get(e[:-1], 0) + n
                    left[e[:-1]] = left.get(e[:-1], 0) + min(n, discount)
            self.classes.append((number, total, left))
            for e, c in counts.items():
                if len(e) == 2 and c[side]:
                    shared[e[1]] = shared.get(e[1], 0) + 1
        self.discount = discount
        self.shared = shared
        self.letters = sum(shared.values()) + 0.5 * (len(shared) + 1)

    def difference(self, expression: str) -> float:
        """Log of the ratio of the last letter's probabilities after those before it."""
        from math import log

        found = self.known.get(expression)
        if found is None:
            chances = []
            for number, total, left in self.classes:
                chance = (self.shared.get(expression[-1], 0) + 0.5) / self.letters
                for k in range(2, len(expression) + 1):
                    part = expression[-k:]
                    n = total.get(part[:-1])
                    if n is None:
                        break
                    chance = (max(number.get(part, 0) - self.discount, 0) + left[part[:-1]] * chance) / n
                chances.append(chance)
            found = log(chances[1] / chances[0])
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[expression] = found
        return found

    def word(self, word: str) -> float:
        line = f" {word} "
        step = self.order
        return sum([self.difference(line[max(0, i - step + 1) : i + 1]) for i in range(1, len(line))])


class Judge:
    """Difference per letter of whole texts, with words remembered."""

    def __init__(self, counts: dict[str, tuple[int, int]], order: int):
        self.pair = Pair(counts, order)
        self.values: dict[str, float] = {}

    def text(self, text: str | None) -> float:
        total, size = 0.0, 0
        get = self.values.get
        for word in _words(text or ""):
            value = get(word)
            if value is None:
                value = self.pair.word(word)
                if len(word) <= LONGEST:
                    if len(self.values) >= REMEMBERED:
                        self.values.clear()
                    self.values[word] = value
            total += value
            size += len(word) + 1
        return total / size if size else 0.0


@dataclass(frozen=True)
class Model:
    """Counts of expressions in ordinary and toxic texts, and the curve from a difference to a score.

    Without texts of both classes there are no counts, and every score is ``base``.
    """

    counts: dict[str, tuple[int, int]]
    slope: float
    base: float
    order: int = ORDER

    def score(self, difference: float) -> float:
        from math import exp

        power = max(-700.0, min(700.0, self.slope * difference + self.base))
        return 1 / (1 + exp(-power))


def _curve(points: list[tuple[float, int, float]]) -> tuple[float, float]:
    """Slope and base of the logistic curve through weighted (difference, label) points, slightly held back."""
    import numpy as np

    x, y, w = (np.array(c, float) for c in zip(*points))
    spread = max(float(np.sqrt(np.average((x - np.average(x, weights=w)) ** 2, weights=w))), 1e-9)
    rows = np.stack([x / spread, np.ones(len(x))], axis=1)
    at = np.zeros(2)
    hold = np.diag([1e-2, 1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        slope = rows.T @ (w * (chance - y)) + hold @ at
        bend = (rows * (w * np.maximum(chance * (1 - chance), 1e-9))[:, None]).T @ rows + hold
        step = np.linalg.solve(bend, slope)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0] / spread), float(at[1])


def _counts(sample: DataFrame, order: int) -> list[tuple]:
    """(expression, numbers in ordinary and toxic texts of the first fold, of the second, ...) of the sample."""

    def words(batches):
        import pyarrow as pa

        for batch in batches:
            seen: dict[tuple[int, str], int] = {}
            for side, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in set(_words(text or "")):
                    seen[side, word] = seen.get((side, word), 0) + 1
            yield pa.record_batch(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["side", "word", "n"],
            )

    def expressions(batches):
        import pyarrow as pa

        for batch in batches:
            found: dict[tuple[int, str], int] = {}
            for side, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for e in _expressions(word, order):
                    found[side, e] = found.get((side, e), 0) + n
            yield pa.record_batch(
                [pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["side", "expression", "n"],
            )

    side = (F.col("_toxic") + 2 * F.col("_fold")).cast("int").alias("side")
    known = sample.select(side, "text").mapInArrow(words, "side int, word string, n long")
    known = known.groupBy("side", "word").agg(F.sum("n").alias("n"))
    single = known.mapInArrow(expressions, "side int, expression string, n long")
    each = [F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(f"n{s}") for s in range(2 * FOLDS)]
    table = single.groupBy("expression").agg(*each).toArrow()
    return list(zip(*(c.to_pylist() for c in table.columns)))


def _judged(df: DataFrame, models: list[Model], keys: list[str], which: Column) -> DataFrame:
    """The key columns and ``difference``, by the model whose number ``which`` gives."""
    version = uuid.uuid4().hex
    counts = [(m.counts, m.order) for m in models]

    def judge(batches):
        import pyarrow as pa

        judges = worker_cache(version, "judges", lambda: [Judge(*c) for c in counts])
        for batch in batches:
            found = [judges[w].text(t) for w, t in zip(*(c.to_pylist() for c in batch.columns[-2:]))]
            yield pa.record_batch([*batch.columns[:-2], pa.array(found, pa.float64())], names=[*keys, "difference"])

    chosen = df.select(*keys, which.cast("int").alias("_which"), F.col("text").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-2])
    return chosen.mapInArrow(judge, f"{kinds}difference double")


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
    order: int = ORDER,
) -> Model:
    """Models of ``docs`` by the labels 0 and 1 that ``labels`` gives to their ids; rows without id, label or text teach nothing.

    Of either class the ids of least hash are taken, as many as the smaller class has and ``sample`` at most; an id with both labels
    counts as toxic. Only their texts are read, by a join with these ids; the driver receives the
    expressions of the sample.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_toxic"))
    known = known.filter(F.col("_toxic").isin(0, 1)).dropna().groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    sizes = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, ordinary = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not ordinary:
        return Model({}, 0.0, 700.0 if toxic else -700.0, order)
    many = min(sample, toxic, ordinary)
    spread = F.xxhash64("_id")
    taken = [known.filter(F.col("_toxic") == side).orderBy(spread, "_id").limit(many) for side in (0, 1)]
    # Twice SAMPLE ids at most.
    chosen = F.broadcast(taken[0].unionByName(taken[1]))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    picked = stash(rows.join(chosen, "_id").withColumn("_fold", fold), "toxicity-sample")
    table = _counts(picked, order)

    def without(fold: int | None) -> dict[str, tuple[int, int]]:
        kept = [f for f in range(FOLDS) if f != fold]
        found = {e: (sum(n[2 * f] for f in kept), sum(n[2 * f + 1] for f in kept)) for e, *n in table}
        return {e: n for e, n in found.items() if any(n)}

    # Each fold is judged by models of the others.
    points = _judged(picked, [Model(without(f), 0, 0, order) for f in range(FOLDS)], ["_toxic"], F.col("_fold")).toArrow()
    weight = {1: toxic, 0: ordinary}
    seen = points.column("_toxic").to_pylist()
    share = {side: weight[side] / max(1, seen.count(side)) * len(seen) / (toxic + ordinary) for side in (0, 1)}
    # In an order of their own, so that sums are the same whatever task came first.
    values = sorted(zip(points.column("difference").to_pylist(), seen, [share[s] for s in seen]))
    slope, base = _curve(values) if values else (0.0, 0.0)
    return Model(without(None), slope, base, order)


def score_toxicity(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns, ``score`` from 0 to 1 and ``predicted``, 1 for a score of 0.5 or more.

    Only the text is looked at, the whole of it. A NULL text is empty, and a text without a letter has no
    difference, so its score is that of the curve's base. Rows are judged one by one, also where they repeat; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*keys, F.col(text).alias("text")) if text not in keys else docs.select(*keys)
    found = _judged(rows, [model], keys, F.lit(0))
    power = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("difference") * model.slope + model.base))
    score = (1 / (1 + F.exp(-power))).alias("score")
    scored = found.select(*keys, score)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
