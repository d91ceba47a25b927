"""Toxicity by weak supervision.

1. Voters. A fixed list of insults and a few patterns vote on a text; further lexicon voters are mined from a
   bounded sample of labelled rows: words and word beginnings that stand in toxic texts far more often than their
   share allows (likelihood ratio above ``SIGNIFICANT``), as far as each adds toxic texts that fewer than ``DEPTH``
   better ones have.
2. Label model. Votes are taken as caused by a hidden label. Expectation-maximisation estimates each voter's rates
   under both labels; correlations between voters given the label are estimated from the same votes, and each
   voter's say is divided by how many voters say the same with it. The result is a posterior label per sampled text.
3. Classifier. Logistic regression on the votes is trained on the posterior labels, in numpy.
4. Every whole text is scored by the classifier.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import arrow_type, field_ddl, text_slices
from millwright.llm.labelled import labelled_sample, remainder

FIT_ROWS, SIGNIFICANT, CLEAN, DEPTH = 12_000, 20.0, 0.85, 3
BEGINNINGS, LONGEST = (3, 4, 5, 6), 24
MOD, HELD, THRESHOLD = 3, 1, 0.7

# Insults that vote toxic in any corpus.
INSULTS = (
    "idiot idiots moron morons stupid scum loser losers trash worthless pathetic disgusting clown clowns dumbass "
    "imbecile cretin filth vermin scumbag degenerate retard bastard asshole bitch"
).split()
PATTERNS = {
    "you-insult": re.compile(r"\b(?:you|your|ur)\b[^.!?\n]{0,20}\b(?:" + "|".join(INSULTS) + r")\b"),
    "shut-up": re.compile(r"\bshut (?:the \w+ )?up\b|\bgo to hell\b|\bdrop dead\b|\bkill yourself\b"),
    "hate": re.compile(r"\b(?:i|we) (?:hate|despise) (?:you|them|those|these)\b"),
}
WORD = re.compile(r"[^\W\d_]+")


def _entries(word: str) -> Iterator[str]:
    """What a word can match: itself, and its beginnings marked by a star."""
    if len(word) <= LONGEST:
        yield word
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n] + "*"


def mined(sample: DataFrame, base: float) -> list[str]:
    """All words and beginnings that point to toxic texts, counted once a text, the most telling first.

    Only entries of some toxic texts of the sample can be significant, so the sample bounds their number.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            n, toxic = Counter(), Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                found = {e for w in set(WORD.findall(text.lower())) for e in _entries(w)}
                n.update(found)
                if y:
                    toxic.update(found)
            keys = list(n)
            columns = [pa.array(keys, pa.string()), pa.array([n[k] for k in keys], pa.int64()), pa.array([toxic[k] for k in keys], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "n", "t"])

    share = F.col("t") / F.col("n")
    rest = F.when(F.col("t") < F.col("n"), (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    ratio = 2 * (F.col("t") * F.log(share / base) + rest)
    counted = sample.select("text", "y").mapInArrow(count, "entry string, n bigint, t bigint")
    summed = counted.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where("t > 0")
    good = summed.where((share >= CLEAN) & (ratio >= SIGNIFICANT)).withColumn("ratio", ratio)
    return [r[0] for r in good.orderBy(F.desc("ratio"), "entry").collect()]


class Voters:
    """The votes of fixed and mined voters on a text."""

    def __init__(self, entries: list[str]):
        self.names = [*PATTERNS, *dict.fromkeys([*INSULTS, *entries])]
        self.number = {e: i for i, e in enumerate(self.names) if i >= len(PATTERNS)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        found = tuple(self.number[e] for e in _entries(word) if e in self.number)
        if len(self.known) >= 200_000:
            self.known.clear()
        self.known[word] = found
        return found

    def fired(self, text: str) -> list[int]:
        low, known = text.lower(), self.known
        out = set()
        for word in set(WORD.findall(low)):
            found = known.get(word)
            out.update(self._of(word) if found is None else found)
        if out:  # each pattern but the last two holds an insult; these two are rare, and cheap to look for
            out.update(i for i, p in enumerate(PATTERNS.values()) if p.search(low))
        elif " up" in low or "hate" in low or "despise" in low or "hell" in low or "dead" in low or "kill" in low:
            out.update(i for i, p in enumerate(PATTERNS.values()) if i and p.search(low))
        return sorted(out)


def votes(sample: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The votes cast on the bounded sample (text and voter of each) and its labels, in the order of ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [voters.fired(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("y"), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "v"])

    frame = sample.select(F.col("doc_id").cast("bigint"), "y", "text")
    got = frame.mapInArrow(run, "doc_id bigint, y int, v array<int>").toArrow().sort_by("doc_id")
    fired = got["v"].to_pylist()  # as many rows as the sample
    text = np.repeat(np.arange(len(fired)), [len(f) for f in fired])
    return text, np.array([v for f in fired for v in f], dtype=np.int64), got["y"].to_numpy()


def needed(text: np.ndarray, voter: np.ndarray, y: np.ndarray, voters: int, base: float, depth: int = DEPTH) -> list[int]:
    """Voters chosen one by one, each the most telling on toxic texts that fewer than ``depth`` chosen ones have."""
    clean = np.bincount(voter[y[text] == 0], minlength=voters)
    on_toxic = y[text] == 1
    text, voter = text[on_toxic], voter[on_toxic]
    chosen: list[int] = []
    have = np.zeros(len(y), dtype=np.int64)
    while True:
        new = np.bincount(voter[have[text] < depth], minlength=voters)
        share = new / np.maximum(new + clean, 1)
        rest = np.where(clean > 0, clean * np.log(np.maximum(1 - share, 1e-9) / (1 - base)), 0)
        ratio = 2 * (new * np.log(np.maximum(share, 1e-9) / base) + rest)
        ratio[(share < CLEAN) | (new == 0)] = 0
        ratio[chosen] = 0
        best = int(ratio.argmax()) if voters else 0
        if not voters or ratio[best] < SIGNIFICANT:
            return chosen
        chosen.append(best)
        have[text[voter == best]] += 1


def label_model(matrix: np.ndarray, base: float, rounds: int = 12) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior of the hidden label per row, from votes alone, and the estimated rates and correlations.

    A voter that doesn't fire abstains; texts on which all abstain are toxic with a tenth of the base rate. A vote's
    log-odds are divided by the sum of its absolute correlations, given the label, with the votes cast on the same text.
    Starts from "any vote means toxic".
    """
    none = ~matrix.any(1)
    n, m = matrix.shape
    posterior = np.where(none, 0.1 * base, 0.9)
    found = {"toxic": np.full(m, 0.5), "clean": np.full(m, 0.5), "correlation": np.eye(m)}
    for _ in range(rounds if n else 0):
        weight = posterior.sum()
        toxic = (posterior @ matrix + 0.05) / (weight + 1)
        clean = ((1 - posterior) @ matrix + 0.005) / (n - weight + 1)
        prior = np.clip(weight / n, 1e-4, 1 - 1e-4)
        rest = matrix - (posterior[:, None] * toxic + (1 - posterior)[:, None] * clean).astype(np.float32)
        covariance = rest.T @ rest / n
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = np.clip(covariance / np.outer(scale, scale), -1, 1)
        np.fill_diagonal(correlation, 1)
        strong = np.where(np.abs(correlation) > 0.1, np.abs(correlation), 0).astype(np.float32)
        say = matrix / np.maximum(matrix @ strong, 1)
        # voters are taken to be better than chance, which keeps the two labels from changing places on few rows
        logit = np.log(prior / (1 - prior)) + say @ np.maximum(np.log(toxic / clean), 0)
        before, posterior = posterior, np.where(none, 0.1 * base, 1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        found = {"toxic": toxic, "clean": clean, "correlation": correlation}
        if np.abs(before - posterior).max() < 1e-3:
            break
    return posterior, found


def linear(matrix: np.ndarray, posterior: np.ndarray, rounds: int = 400, rate: float = 2.0, ridge: float = 2e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on the votes with posterior labels; fixed voters never seen get the mean weight of those seen."""
    n, m = matrix.shape
    if not n:
        return np.full(m, 6.0), -3.0
    weight, bias = np.full(m, 4.0), -3.0
    scale = np.sqrt(n / (1 + matrix.sum(0)))  # rare votes take larger steps
    for step in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(matrix @ weight + bias, -30, 30))) - posterior
        now = rate * (1 - step / rounds)
        weight -= now * (scale * (error @ matrix) / n + ridge * weight)
        bias -= now * error.mean()
    seen = matrix.any(0)
    weight[~seen] = weight[seen].mean() if seen.any() else 6.0
    return weight, float(bias)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[Voters, np.ndarray, float]:
    """Voters, weights and bias from a sample of at most ``rows`` labelled rows that are not held out."""
    from millwright.session import written

    sample = written(labelled_sample(docs, labels, "toxic", MOD, HELD, rows), "sample")
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    base = (toxic + 1) / (n + 2)
    voters = Voters(mined(sample, base))
    text, voter, y = votes(sample, voters)
    fixed = len(PATTERNS) + len(INSULTS)
    free = voter >= fixed
    chosen = needed(text[free], voter[free] - fixed, y, len(voters.names) - fixed, base)
    kept = np.array([*range(fixed), *(fixed + i for i in sorted(chosen))])
    place = np.full(len(voters.names), -1)
    place[kept] = np.arange(len(kept))
    cast = place[voter] >= 0
    matrix = np.zeros((len(y), len(kept)), dtype=np.float32)
    matrix[text[cast], place[voter[cast]]] = 1
    voters = Voters([voters.names[i] for i in kept[len(PATTERNS) :]])
    posterior, _ = label_model(matrix, base)
    weight, bias = linear(matrix, posterior)
    return voters, weight, bias


Model = tuple[Voters, np.ndarray, float]


def _scores(docs: DataFrame, model: Model):
    """A function from texts to scores for use in tasks; the model is broadcast."""
    names, (_, weight, bias) = model[0].names, model
    sent = docs.sparkSession.sparkContext.broadcast((names[len(PATTERNS) :], weight, bias))  # mined entries of the sample and the fixed ones

    def begin():
        entries, weight, bias = sent.value
        voters = Voters(entries)

        def scores(texts: pa.Array) -> np.ndarray:
            logit = np.array([weight[voters.fired(t or "")].sum() + bias for t in texts.to_pylist()])
            return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))

        return scores

    return begin


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``score`` per row, from the whole text; a text without votes scores by the bias alone."""
    frame = docs.select(*keys, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    types = [arrow_type(frame, k) for k in keys]
    begin = _scores(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = begin()
        for batch in text_slices(batches):
            columns = [*(batch.column(k).cast(t) for k, t in zip(keys, types)), pa.array(scores(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "score"])

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``: one pass, without numbers or joins."""
    begin = _scores(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = begin()
        for batch in text_slices(batches):
            yield batch.filter(pa.array(scores(batch.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per row; one model fitted on a sample of ``labels.toxic``.

    Every row gives one row, repeated rows too; null and empty texts have no votes. Only text enters a score.
    Without labels the fixed voters decide.
    """
    scored = score(docs, fit(docs, labels, fit_rows))
    held = remainder(F.col("doc_id"), MOD) == HELD
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
