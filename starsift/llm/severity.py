"""Toxicity as ordered severity grades: cumulative-link regression on sparse words."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import SLICE_ROWS, bounded_batches, id_and_bytes, id_and_text, release, stored, text_chunks, worker_memo, written

#: Labelled documents the model is fitted on: a documented bound of the sample.
SAMPLE_ROWS = 20_000
#: A feature is evidence if, of all features held by so many documents, fewer than this would be expected to stand in
#: as many toxic ones by chance.
CHANCE = 0.05
#: L2 penalties cross-validation chooses from.
PENALTIES = (1e-2, 1e-3, 1e-4)
#: The fit ends once no part of the gradient exceeds this.
TOLERANCE = 1e-5
#: Severity grades above 0.
GRADES = 3
#: Parts of the sample: each is judged by a model of the others to choose the cut.
FOLDS = 3
#: The cut is at least this many times the probability of a text without evidence.
ABOVE_NONE = 1.5
#: Letters of the word beginnings that are features beside whole words, so that inflected words count together.
STEMS = (4, 5, 6)
#: Evidence counts as dense where it stands at least so often and on so many of the runs without blanks.
DENSE_TIMES, DENSE_SHARE = 2, 1 / 200
LETTERS = re.compile(r"[^\W\d_]+")
MEMO = 200_000


@dataclass
class SeverityModel:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]); x marks the vocabulary words a text holds.

    `cut` is the least probability of any grade above 0 at which a document is toxic.
    """

    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float
    held_out: dict

    def above(self, scores: np.ndarray) -> np.ndarray:
        """Probabilities of being above each threshold, one row per score."""
        if not len(self.thresholds):
            return np.zeros((len(scores), GRADES))
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))


class Marks:
    """Sparse 0/1 rows: row r[i] has a one at column c[i]; held in order of rows and in order of columns."""

    def __init__(self, n: int, width: int, r: np.ndarray, c: np.ndarray):
        r, c = r.astype(np.int32), c.astype(np.int32)
        self.n, self.width, self.r, self.c = n, width, r, c
        self.rows, self.row_begins = np.unique(r, return_index=True)
        order = np.argsort(c, kind="stable")
        self.r_by_column = r[order]
        self.columns, self.column_begins = np.unique(c[order], return_index=True)

    @staticmethod
    def of(held: list[list[int]], width: int) -> Marks:
        sizes = [len(h) for h in held]
        return Marks(len(held), width, np.repeat(np.arange(len(held)), sizes), np.array([p for h in held for p in h], np.int64))

    def some(self, rows: np.ndarray) -> Marks:
        """The rows a mask names."""
        keep = rows[self.r]
        return Marks(int(rows.sum()), self.width, (np.cumsum(rows) - 1)[self.r[keep]], self.c[keep])

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.rows):
            out[self.rows] = np.add.reduceat(w[self.c], self.row_begins)
        return out

    def sums(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        if len(self.columns):
            out[self.columns] = np.add.reduceat(g[self.r_by_column], self.column_begins)
        return out


def _ordinal_loss(x: Marks, y: np.ndarray, grades: int, penalty: float, at: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with an L2 penalty, and its gradient.

    `at` holds the weights, then the first threshold and the logarithms of the gaps, so thresholds stay in order.
    """
    w, cuts = at[: x.width], at[x.width :]
    gaps = np.exp(np.clip(cuts[1:], -30, 30))
    edges = np.concatenate([[-np.inf], np.cumsum(np.concatenate([[cuts[0]], gaps])), [np.inf]])
    z = x.times(w)
    with np.errstate(over="ignore"):
        up = 1 / (1 + np.exp(-(edges[y + 1] - z)))  # P(grade <= y)
        down = 1 / (1 + np.exp(-(edges[y] - z)))  # P(grade < y)
    p = np.maximum(up - down, 1e-300)
    g_up, g_down = up * (1 - up) / p / len(y), down * (1 - down) / p / len(y)
    # grade y lies under threshold y and over threshold y - 1
    g_theta = np.bincount(np.maximum(y - 1, 0), np.where(y > 0, g_down, 0), grades)[:grades] - np.bincount(y, g_up, grades + 1)[:grades]
    g_cuts = np.cumsum(g_theta[::-1])[::-1].copy()
    g_cuts[1:] *= gaps
    return float(-np.log(p).mean() + penalty / 2 * (w @ w)), np.concatenate([x.sums(g_up - g_down) + penalty * w, g_cuts])


def fit_ordinal(
    x: Marks | np.ndarray, y: np.ndarray, grades: int, penalty: float = 1e-4, start_at: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by limited-memory quasi-Newton steps, until the gradient vanishes or no step helps.

    `start_at` is a result to begin with; it changes the time, not where the steps end.
    """
    if isinstance(x, np.ndarray):
        x = Marks.of([np.flatnonzero(row).tolist() for row in x], x.shape[1])
    share = np.array([np.clip((y > k).mean(), 1e-4, 1 - 1e-4) for k in range(grades)])
    start = np.log(1 / share - 1)
    at = np.concatenate([np.zeros(x.width), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    if start_at is not None:
        w, theta = start_at
        at = np.concatenate([w, [theta[0]], np.log(np.maximum(np.diff(theta), 1e-12))])
    value, g = _ordinal_loss(x, y, grades, penalty, at)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    while np.abs(g).max() > TOLERANCE:
        d, kept = -g, []
        for s, t, rho in reversed(steps):
            kept.append(rho * (s @ d))
            d = d - kept[-1] * t
        if steps:
            s, t, rho = steps[-1]
            d = d / (rho * (t @ t))
        for (s, t, rho), alpha in zip(steps, reversed(kept), strict=True):
            d = d + (alpha - rho * (t @ d)) * s
        slope, size = g @ d, 1.0 if steps else 1 / max(1.0, np.abs(g).sum())
        while True:
            after, g_after = _ordinal_loss(x, y, grades, penalty, at + size * d)
            if after <= value + 1e-4 * size * slope or size < 1e-12:
                break
            size /= 2
        if not after < value:
            break
        s, t = size * d, g_after - g
        if s @ t > 1e-12 * (t @ t):
            steps = [*steps[-9:], (s, t, 1 / (s @ t))]
        at, value, g = at + s, after, g_after
    return at[: x.width], np.cumsum(np.concatenate([[at[x.width]], np.exp(at[x.width + 1 :])]))


def features(word: str) -> list[str]:
    """The word, and its beginnings with a star."""
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


def features_of_run(run: bytes) -> list[str]:
    """Features of all words in a run without blanks."""
    return [f for w in LETTERS.findall(run.decode().lower()) for f in features(w)]


def broader(feature: str) -> list[str]:
    """Features that a text with this one holds as well."""
    base = feature.rstrip("+")
    word = base.rstrip("*")
    begins = [word[:k] + "*" for k in STEMS if k < len(word)]
    if base == feature:
        return begins
    return [base, *begins, *[s + "+" for s in begins]]


def least_dense(runs: int) -> float:
    """Times from which a feature is dense in a text of so many runs."""
    return max(DENSE_TIMES, DENSE_SHARE * runs)


def held_features(text: bytes) -> set[str]:
    """All features of a text; those that are dense also with a plus."""
    runs = text.split()
    times: Counter = Counter()
    for run, n in Counter(runs).items():
        for f in features_of_run(run):
            times[f] += n
    least = least_dense(len(runs))
    return times.keys() | {f + "+" for f, n in times.items() if n >= least}


def best_cut(p: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F1, in the middle of the gap below the lowest accepted probability."""
    if not toxic.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(toxic[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + toxic.sum())
    last_of_value = np.append(p[order][1:] != p[order][:-1], True)
    best = int(np.argmax(np.where(last_of_value, f1, -1)))
    after = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + after) / 2)


def chance_of(toxic: int, held: int, n_toxic: int, n: int, ln: np.ndarray) -> float:
    """Probability that of `held` documents drawn from n, n_toxic of them toxic, so many or more are toxic.

    `ln` holds the logarithms of the factorials up to n.
    """
    k = np.arange(max(toxic, held - n + n_toxic), min(held, n_toxic) + 1)
    ways = ln[n_toxic] - ln[k] - ln[n_toxic - k] + ln[n - n_toxic] - ln[held - k] - ln[n - n_toxic - held + k]
    return float(np.exp(ways - (ln[n] - ln[held] - ln[n - held])).sum())


def least_toxic(held: int, features: int, n_toxic: int, n: int, ln: np.ndarray) -> int:
    """From how many toxic documents on a feature of `held` documents is evidence, if `features` are as frequent."""
    low, high = held * n_toxic // n + 1, min(held, n_toxic) + 1
    while low < high:
        middle = (low + high) // 2
        if chance_of(middle, held, n_toxic, n, ln) * features < CHANCE:
            high = middle
        else:
            low = middle + 1
    return low


def fit_severity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> SeverityModel:
    """A model from 0 / 1 labels, fitted on at most `sample_rows` labelled documents (the first by a hash of the id).

    Evidence: all words and word beginnings whose presence, or whose dense presence, stands in more toxic documents than
    chance explains, given how many features are as frequent (`CHANCE`); counted by Spark over the sample. A word whose
    beginning is as clear evidence is left out. Grades of toxic documents are thirds of how dense the words that speak
    for toxicity stand in them; documents that are not toxic have grade 0. The penalty is chosen by cross-validation,
    the fit runs until its gradient vanishes. Without usable labels the model has no words and calls nothing toxic. Null
    labels and null ids are left out; of repeated labels the highest counts, of rows that share an id the largest text.
    """
    before = written()
    marked = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = id_and_text(docs, id_col, text_col).filter("text is not null")
    texts = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    sample = stored(texts.select("doc_id", F.col("text").cast("binary").alias("text"), "toxic"))

    def pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield [c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns]

    def counts_of(batches):
        for _, texts, marks in pieces(batches):
            seen: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(texts, marks, strict=True):
                seen[toxic > 0].update(held_features(text))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([seen[k][f] for f in names], pa.int64()) for k in (1, 0)]], names=["word", "a", "b"]
            )

    is_toxic = (F.col("toxic") > 0).alias("toxic")
    totals = {r.toxic: r.n for r in sample.groupBy(is_toxic).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic or not n_clean:
        release(docs.sparkSession, before, docs, labels)
        return SeverityModel([], np.zeros(0), np.zeros(0), 0.5, {})
    counted = sample.mapInArrow(counts_of, "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counted = stored(counted.withColumn("held", F.col("a") + F.col("b")))
    n = n_toxic + n_clean
    as_frequent = counted.groupBy("held").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per count, at most the sample's rows
    ln = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    least = [(r.held, least_toxic(r.held, r.n, n_toxic, n, ln)) for r in as_frequent]
    bounds = docs.sparkSession.createDataFrame(least, "held long, least long")
    top = counted.join(F.broadcast(bounds), "held").filter("a >= least").collect()
    chosen: dict = {}
    for r in sorted(top, key=lambda r: (-r.a / r.held, -r.a, len(r.word), r.word)):
        stems = [chosen[s] for s in broader(r.word) if s in chosen]
        if not any(t.a / (t.a + t.b) >= r.a / (r.a + r.b) - 0.02 for t in stems):
            chosen[r.word] = r
    words = list(chosen)

    def marks_of(batches):
        held_by = evidence(words)
        for ids, texts, marks in pieces(batches):
            found = [held_by(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.float64()), pa.array(marks, pa.int32())],
                names=["doc_id", "held", "density", "toxic"],
            )

    schema = "doc_id long, held array<int>, density double, toxic int"
    rows = sample.mapInArrow(marks_of, schema).toArrow().combine_chunks().sort_by("doc_id")
    release(docs.sparkSession, before, docs, labels)
    held = rows.column("held").combine_chunks()
    sizes = np.asarray(held.value_lengths())
    x = Marks(len(sizes), len(words), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.asarray(held.flatten()))
    toxic, density = np.asarray(rows.column("toxic")) > 0, np.asarray(rows.column("density"))
    thirds = np.quantile(density[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + np.searchsorted(thirds, density, side="right"), 0)
    fold = np.arange(x.n) % FOLDS
    tried = []
    parts = [(x.some(fold != k), grade[fold != k]) for k in range(FOLDS)]
    fits: list = [None] * FOLDS
    for penalty in PENALTIES:
        p = np.zeros(x.n)
        for k in range(FOLDS):
            weights, thresholds = fits[k] = fit_ordinal(*parts[k], GRADES, penalty, fits[k])
            p[fold == k] = SeverityModel(words, weights, thresholds, 0.5, {}).above(x.times(weights)[fold == k])[:, 0]
        miss = -np.log(np.clip(np.where(toxic, p, 1 - p), 1e-12, 1)).mean()
        tried.append((miss, penalty, p))
    _, penalty, p = min(tried, key=lambda t: t[:2])
    weights, thresholds = fit_ordinal(x, grade, GRADES, penalty, fits[0])
    model = SeverityModel(words, weights, thresholds, 0.5, {})
    model.cut = cut = max(best_cut(p, toxic), min(0.9, ABOVE_NONE * float(model.above(np.zeros(1))[0, 0])))
    called = p >= cut
    model.held_out = {
        "rows": x.n, "toxic": int(toxic.sum()), "hits": int((called & toxic).sum()), "false": int((called & ~toxic).sum())
    }
    return model


class _Places(dict):
    """Memo from a run without blanks to the places of the features in it, whether or not they must be dense."""

    def __init__(self, place: dict[str, int]):
        super().__init__()
        self.place = place

    def __missing__(self, run: bytes):
        named = features_of_run(run)
        out = tuple(p for f in [*named, *[f + "+" for f in named]] if (p := self.place.get(f)) is not None)
        if len(self) >= MEMO:
            self.clear()
        self[run] = out
        return out


def evidence(words: list[str]):
    """A function from a byte text to the sorted places of the vocabulary it holds, and the share of runs that hold any."""
    places = _Places({w: i for i, w in enumerate(words)})
    must_be_dense = [w.endswith("+") for w in words]

    def held_by(text: bytes) -> tuple[list[int], float]:
        runs = text.split()
        least = least_dense(len(runs))
        times: Counter = Counter()
        spoken = []
        for run, n in Counter(runs).items():
            if at := places[run]:
                spoken.append((at, n))
                for p in at:
                    times[p] += n
        held = {p for p, n in times.items() if not must_be_dense[p] or n >= least}
        strong = sum(n for at, n in spoken if not held.isdisjoint(at))
        return sorted(held), strong / max(1, len(runs))

    return held_by


def scorer(model: SeverityModel):
    """A function from byte texts to the probabilities of being above each grade, and to whether each is toxic.

    Its memo stays in the Python worker for the next task.
    """
    named = sha256("\n".join(model.words).encode()).hexdigest()
    held_by = worker_memo(("evidence", named), lambda: evidence(model.words))

    def score(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        scores = np.zeros(len(texts))
        for i, text in enumerate(texts):
            if text and (held := held_by(text)[0]):
                scores[i] = model.weights[held].sum()
        above = model.above(scores)
        known = np.array([bool(t) for t in texts], bool)
        return above, known & (above[:, 0] >= model.cut) & (len(model.words) > 0)

    return score


def score_severity(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade, 0 to GRADES), p_toxic, grade (most likely) and toxic of every row.

    One pass without a shuffle; the whole text counts. Null and empty texts hold no word, get the model's base severity
    and are not toxic; repeated rows stay; a null id stays null; an empty table gives no rows; other columns are not read.
    """

    def run(batches):
        score = scorer(model)
        for ids, texts in text_chunks(batches, 5_000, 32 << 20):
            above, toxic = score(texts)
            each = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, 0]),
                    pa.array(each.argmax(axis=1), pa.int32()),
                    pa.array(toxic),
                ],
                names=["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    schema = "doc_id long, severity double, p_toxic double, grade int, toxic boolean"
    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that the model does not call toxic; null and empty texts stay, repeated rows too."""
    column = docs.columns.index(text_col)
    bounded_batches(docs.sparkSession)

    def run(batches):
        score = scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column(column).cast(pa.binary()).to_pylist()
                kept = part.filter(pa.array(~score(texts)[1]))
                if kept.num_rows:
                    yield kept

    return docs.mapInArrow(run, docs.schema)
