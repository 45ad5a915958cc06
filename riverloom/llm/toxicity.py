"""Toxicity classifier whose scores change little when group names are swapped.

Features are words (lower-cased, outer punctuation removed) and their first 4, 5 and
6 bytes, by hash; only whether a text has them counts, so a long text is not diluted.
The classifier is fitted on a sample of at most ``per_class`` labelled rows of each class,
chosen by a hash of the id; its bound is a parameter, and all rows are scored. Features
are the ``n_features`` of the sample most tied to the toxic class (G statistic), and all
names of groups.

Every labelled sentence that names a group is also taken with the name swapped for
others of its list, neutral words among them. The loss is that of logistic regression
plus ``penalty`` times the mean squared difference between the scores (before the
sigmoid) of a text and its swapped forms. So a name's weight is drawn to that of the
neutral words, however often the sample's toxic texts happen to have it.

Both classes weigh the same, so a score of 0.5 is where a text is as likely among toxic as
among other texts, whatever their numbers. Null and empty texts are scored by the constant alone. Rows
with a null id or label are not learned from; an id with several labels is toxic if one
of them is. Without rows of both classes every score is the share of toxic rows, or 0
where there is no label at all. Empty tables give empty results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.llm.words import Texts, mix, pieces, range_hashes, signed
from riverloom.session import map_arrow, saved

PER_CLASS = 4000
N_FEATURES = 4096
PREFIXES = (4, 5, 6)

#: names that may stand for each other, with neutral words, by language
GROUPS = (
    ("women", "men", "people", "adults", "persons", "transgender", "nonbinary"),
    ("woman", "man", "person", "human"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "religious", "local"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "believers", "neighbours"),
    ("black", "white", "asian", "african", "european", "american", "latino", "arab", "human"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "married"),
    ("immigrants", "refugees", "foreigners", "citizens", "residents", "people"),
    ("disabled", "blind", "deaf", "old", "young", "tall"),
    ("frauen", "männer", "menschen", "leute"),
    ("muslime", "christen", "juden", "buddhisten", "gläubige", "nachbarn"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "menschen"),
    ("schwule", "lesben", "heterosexuelle", "paare"),
    ("ausländer", "flüchtlinge", "einwanderer", "bürger", "leute"),
    ("femmes", "hommes", "gens", "personnes"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "croyants", "voisins"),
    ("noirs", "blancs", "asiatiques", "africains", "européens", "humains"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "couples"),
    ("immigrés", "réfugiés", "étrangers", "citoyens", "habitants"),
    ("mujeres", "hombres", "gente", "personas"),
    ("musulmanes", "cristianos", "judíos", "budistas", "creyentes", "vecinos"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos", "humanos"),
    ("homosexuales", "lesbianas", "heterosexuales", "parejas"),
    ("inmigrantes", "refugiados", "extranjeros", "ciudadanos", "residentes"),
)


def feature_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every feature of every word; repeats are kept."""
    starts, ends = texts.trimmed()
    row = texts.rows()
    values = texts.byte_values
    rows, hashes = [row], [range_hashes(values, starts, ends)]
    for k in PREFIXES:
        longer = ends - starts > k
        rows.append(row[longer])
        hashes.append(mix(range_hashes(values, starts[longer], starts[longer] + k) + np.uint64(k)))
    return np.concatenate(rows), np.concatenate(hashes)


def name_hashes(groups=GROUPS) -> np.ndarray:
    """Features of all group names."""
    names = pa.array(sorted({n for g in groups for n in g}))
    return np.unique(np.concatenate([feature_hashes(t)[1] for _, _, t in pieces(names, fold=True)] or [np.zeros(0, np.uint64)]))


def swapped(text: str, groups=GROUPS, times: int = 3) -> list[str]:
    """The text with every group name replaced by the next, second next ... of its list."""
    nexts: dict[str, tuple] = {}
    for g in groups:
        for i, n in enumerate(g):
            nexts.setdefault(n, (g, i))
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, sorted(nexts, key=len, reverse=True))) + r")\b", re.IGNORECASE)
    if not pattern.search(text):
        return []

    def other(step):
        def replace(match):
            group, i = nexts[match[0].lower()]
            return group[(i + step) % len(group)]

        return replace

    return [pattern.sub(other(step), text) for step in range(1, times + 1)]


@dataclass(frozen=True)
class Classifier:
    #: sorted features and their weights
    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: Texts) -> np.ndarray:
        rows = len(texts.offsets) - 1
        z = np.full(rows, self.bias)
        if len(self.hashes):
            # most words are no feature: a table of their low bits sorts them out
            maybe = np.zeros(1 << 16, bool)
            maybe[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
            row, found = feature_hashes(texts)
            some = maybe[(found & np.uint64(0xFFFF)).astype(np.int64)]
            row, found = row[some], found[some]
            at = np.searchsorted(self.hashes, found)
            at[at == len(self.hashes)] = 0
            hit = self.hashes[at] == found
            pair = np.unique(row[hit] * len(self.hashes) + at[hit])
            z += np.bincount(pair // len(self.hashes), self.weights[pair % len(self.hashes)], rows)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _count_features(batches):
    """Numbers of toxic and other texts of the sample with each feature."""
    for batch in batches:
        toxic = batch["toxic"].to_numpy()
        for lo, hi, texts in pieces(batch["text"], fold=True):
            row, found = feature_hashes(texts)
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
            row, found = row[new], found[new]
            keys, which = np.unique(found, return_inverse=True)
            bad = np.bincount(which, toxic[lo + row], len(keys)).astype(np.int64)
            every = np.bincount(which, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys)), pa.array(bad), pa.array(every - bad)], ["feature", "bad", "good"]
            )


def _sample_features(hashes: np.ndarray, groups):
    """Selected features of each text and of its swapped forms (variant above 0)."""

    def run(batches):
        for batch in batches:
            ids, toxic, texts = (batch[c].to_pylist() for c in ("doc_id", "toxic", "text"))
            forms = [[t or "", *swapped(t or "", groups)] for t in texts]
            flat = pa.array([f for fs in forms for f in fs], pa.string())
            found: list[np.ndarray] = []
            for lo, hi, part in pieces(flat, fold=True):
                row, values = feature_hashes(part)
                at = np.searchsorted(hashes, values)
                at[at == len(hashes)] = 0
                hit = hashes[at] == values
                row, at = row[hit], at[hit]
                found += [np.unique(at[row == r]) for r in range(hi - lo)]
            owner = [(i, t, v) for i, t, fs in zip(ids, toxic, forms) for v in range(len(fs))]
            i, t, v = zip(*owner) if owner else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int64()), pa.array(t, pa.int32()), pa.array(v, pa.int32()), pa.array([x.tolist() for x in found], pa.list_(pa.int32()))],
                ["doc_id", "toxic", "variant", "features"],
            )

    return run


def regression(
    x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int,
    penalty: float, ridge: float = 1e-5, steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights of present features and constant, by full gradients with adapted steps.

    pairs: the features of a text and of a swapped form of it.
    """
    flat = np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(x)), [len(r) for r in x])
    only = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in pairs]
    pair_at = np.concatenate([np.concatenate(p) for p in only] or [np.zeros(0)]).astype(np.int64)
    sign = np.concatenate([np.repeat([1.0, -1.0], [len(a), len(b)]) for a, b in only] or [np.zeros(0)])
    pair_owner = np.repeat(np.arange(len(only)), [len(a) + len(b) for a, b in only])
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(owner, w[flat], len(x)) + b
        slope = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * balance
        g = np.append(np.bincount(flat, slope[owner], size) + ridge * w, slope.sum())
        if len(only):
            gap = np.bincount(pair_owner, sign * w[pair_at], len(only))
            g[:size] += np.bincount(pair_at, sign * gap[pair_owner], size) * (2 * penalty / len(only))
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:size]
        b -= move[size]
    return w, float(b)


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, n_features: int = N_FEATURES,
    penalty: float = 1.0, groups=GROUPS, seed: int = 3,
) -> Classifier:
    """Classifier from docs (doc_id, text) and labels (doc_id, toxic)."""
    labels = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    good, bad = counts.get(0, 0), counts.get(1, 0)
    none = np.zeros(0, np.uint64), np.zeros(0)
    if not bad:
        return Classifier(*none, -500.0)
    if not good:
        return Classifier(*none, 500.0)
    order = F.xxhash64(F.lit(seed), "doc_id")
    one = lambda k: labels.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(per_class)
    chosen = F.broadcast(one(0).unionByName(one(1)))  # 2 * per_class rows at most
    sample = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id"), "toxicity-sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_good, n_bad = sizes.get(0, 0), sizes.get(1, 0)
    if not n_good or not n_bad:
        share = bad / (good + bad)
        return Classifier(*none, float(np.log(share / (1 - share))))

    tied = map_arrow(sample.select("toxic", "text"), _count_features, "feature long, bad long, good long")
    tied = tied.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    share = F.lit(n_bad / (n_good + n_bad))
    times = F.col("bad") + F.col("good")
    log = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    strength = log(F.col("bad"), times * share) + log(F.col("good"), times * (1 - share))
    best = (
        tied.where((times >= 3) & (F.col("bad") > times * share))
        .orderBy(strength.desc(), "feature")
        .limit(n_features)
        .select("feature")
        .collect()
    )
    own = np.array([r.feature for r in best], np.int64).view(np.uint64)
    hashes = np.unique(np.concatenate((own, name_hashes(groups))))
    rows = map_arrow(
        sample, _sample_features(hashes, groups), "doc_id long, toxic int, variant int, features array<int>"
    ).collect()
    rows.sort(key=lambda r: (r.doc_id, r.variant, r.features))
    plain = {r.doc_id: np.array(r.features, np.int64) for r in rows if r.variant == 0}
    x = [np.array(r.features, np.int64) for r in rows if r.variant == 0]
    y = np.array([r.toxic for r in rows if r.variant == 0])
    pairs = [(plain[r.doc_id], np.array(r.features, np.int64)) for r in rows if r.variant]
    weights, bias = regression(x, y, pairs, len(hashes), penalty)
    return Classifier(hashes, weights, bias)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id and score, the probability of the toxic class, of every row of docs."""

    def run(batches):
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"], fold=True):
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()), pa.array(model.scores(texts))], ["doc_id", "score"]
                )

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def below(docs: DataFrame, model: Classifier, limit: float = 0.5) -> DataFrame:
    """The rows of docs (text and any other columns) with a score below the limit."""

    def run(batches):
        for batch in batches:
            for lo, hi, texts in pieces(batch["text"], fold=True):
                yield batch.slice(lo, hi - lo).filter(pa.array(model.scores(texts) < limit))

    return map_arrow(docs, run, docs.schema)
