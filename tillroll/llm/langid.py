"""Language identification by interpolated Kneser-Ney character models.

One model a language, fitted on a bounded sample of labelled documents.  The
grams of a family of up to 8 languages share one sorted array of hashes per
order, with a row of log probabilities per gram (a column a language), discounts
and lower orders already interpolated, so the arrays grow in proportion to the
languages.  A gram that is missing falls back over the weight of its
context, kept in a second sorted array.  The language of the lowest cross-entropy
per character wins; a text that fits even that language worse than documents of
its length do in calibration is marked as rejected.

Defined results: texts are lower-cased, and runs of anything but letters are one
space; a null text or one without a letter is ``und`` with score 0 and rejected;
ties go to the first language in alphabetical order; repeated rows are scored
alike; without any labelled row every document is ``und``; empty tables give no
rows; whole texts are read, in pieces of bounded size.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpointed, map_batches, threshold

PIECE = 1 << 19  # code points scored at once
SPACE = 32
STEP = np.uint64(0x9E3779B97F4A7C15)
UNDETERMINED = "und"
FAMILY = 8  # languages that share their arrays
LEAST_APART = 20  # documents of a language from which on some only calibrate


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), dtype=np.uint8).astype(bool)


class Letters:
    """Texts as code points: letters lower-cased, all else one space."""

    def __init__(self):
        self.table = _letter_table()

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = self.table[codes]
        kept = letter.copy()
        kept[1:] |= letter[:-1]  # the first of a run of other characters stays, as a space
        return np.where(letter, codes, SPACE)[kept]


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the grams that end at each position, for orders 1 to ``order``.

    Positions before ``order`` - 1 have grams that wrap; callers skip them.
    """
    at = codes.astype(np.uint64)
    out = [at]
    for _ in range(order - 1):
        before = np.empty_like(at)
        before[0] = 0
        before[1:] = out[-1][:-1]
        out.append(before * STEP + at)
    return out


def _spot(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key in a sorted table, -1 where it is missing."""
    if not len(table):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _hash_rows(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of code points (a gram), as ``gram_hashes`` gives it."""
    out = np.zeros(len(codes), dtype=np.uint64)
    for column in codes.T:
        out = out * STEP + column.astype(np.uint64)
    return out


class Family:
    """Kneser-Ney models of a few languages over shared sorted hash arrays."""

    def __init__(self, grams: dict[str, dict[str, int]], order: int, letters: int):
        self.order, self.languages = order, sorted(grams)
        self.keys, self.logp, self.contexts, self.weights = [], [], [], []
        raw = {}  # (order, language) -> (code rows, counts)
        for lang in self.languages:
            items = sorted(grams[lang].items())
            rows = np.array([[ord(c) for c in g] for g, _ in items], dtype=np.uint32).reshape(-1, order)
            counts = np.array([c for _, c in items], dtype=np.float64)
            for n in range(order, 0, -1):
                raw[n, lang] = rows, counts
                # Continuation counts: in how many distinct grams of this order the shorter one ends.
                rows, counts = np.unique(rows[:, 1:], axis=0, return_counts=True) if n > 1 else (rows, counts)
                counts = counts.astype(np.float64)
        lower = None
        for n in range(1, order + 1):
            rows = np.unique(np.concatenate([raw[n, lang][0] for lang in self.languages]), axis=0)
            hashes = _hash_rows(rows)
            by = np.argsort(hashes)
            rows, keys = rows[by], hashes[by]
            heads = np.unique(_hash_rows(rows[:, :-1]))
            suffix = _spot(self.keys[-1], _hash_rows(rows[:, 1:])) if n > 1 else None
            p = np.empty((len(keys), len(self.languages)))
            weights = np.ones((len(heads), len(self.languages)))
            for j, lang in enumerate(self.languages):
                own, counts = raw[n, lang]
                ones, twos = (counts == 1).sum(), (counts == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.5
                head = _spot(heads, _hash_rows(own[:, :-1]))
                total = np.bincount(head, counts, len(heads))
                types = np.bincount(head, minlength=len(heads))
                weights[:, j] = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
                seen = np.zeros(len(keys))
                seen[_spot(keys, _hash_rows(own))] = np.maximum(counts - discount, 0) / total[head]
                base = lower[suffix, j] if n > 1 else 1.0 / (letters + 1)
                p[:, j] = seen + weights[_spot(heads, _hash_rows(rows[:, :-1])), j] * base
            lower = p
            self.keys.append(keys)
            self.logp.append(np.log(p).astype(np.float32))
            self.contexts.append(heads)
            self.weights.append(np.log(weights).astype(np.float32))
        self.unseen = (self.weights[0][0] - np.log(letters + 1)).astype(np.float32)

    def score(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Log probability of each position, from the hashes of its grams; a column a language."""
        out = np.zeros((len(hashes[0]), len(self.languages)), dtype=np.float32)
        left = np.arange(len(hashes[0]))
        for n in range(self.order, 0, -1):
            spot = _spot(self.keys[n - 1], hashes[n - 1][left])
            hit = spot >= 0
            out[left[hit]] += self.logp[n - 1][spot[hit]]
            left = left[~hit]
            if not len(left):
                break
            if n > 1:
                context = _spot(self.contexts[n - 1], hashes[n - 2][left - 1])
                known = context >= 0
                out[left[known]] += self.weights[n - 1][context[known]]
            else:
                out[left] += self.unseen
        return out


class Model:
    """Kneser-Ney models of all languages, in families, and where documents of each language lie."""

    def __init__(self, grams: dict[str, dict[str, int]], order: int):
        self.order, self.languages = order, sorted(grams)
        self.centre = np.zeros(len(self.languages))
        self.spread = np.full(len(self.languages), np.inf)
        letters = len({g[-1] for own in grams.values() for g in own})
        self.families = [Family({lang: grams[lang] for lang in self.languages[i:i + FAMILY]}, order, letters)
                         for i in range(0, len(self.languages), FAMILY)]

    def entropies(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character, a column a language; characters) of each text's codes."""
        lead = self.order - 1
        pad = np.full(lead, SPACE, dtype=np.uint32)
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        held, size = [], 0

        def settle():
            nonlocal held, size
            if held:
                hashes = gram_hashes(np.concatenate([x for _, x in held]), self.order)
                for f, family in enumerate(self.families):
                    logp, own, at = family.score(hashes), slice(f * FAMILY, (f + 1) * FAMILY), 0
                    for i, x in held:
                        sums[i, own] -= logp[at + lead:at + len(x)].sum(axis=0, dtype=np.float64)
                        at += len(x)
            held, size = [], 0

        for i, codes in enumerate(texts):
            counts[i] = len(codes)
            padded = np.concatenate([pad, codes])
            for lo in range(0, len(codes), PIECE):
                piece = padded[lo:lo + PIECE + lead]
                if size + len(piece) > PIECE + lead:
                    settle()
                held.append((i, piece))
                size += len(piece)
        settle()
        return sums / np.maximum(counts, 1)[:, None], counts

    def calibrate(self, measured: list[tuple[str, float, int]], quantile: float, slack: float) -> None:
        """Where documents of each language lie: centre, and spread by 1 / sqrt(characters).

        ``measured`` has (language, its cross-entropy, characters) of documents that were not learned from."""
        for j, lang in enumerate(self.languages):
            own = np.array([(x, n) for label, x, n in measured if label == lang and n]).reshape(-1, 2)
            if len(own):
                x, n = own.T
                self.centre[j] = np.average(x, weights=n) + slack
                self.spread[j] = max(1.0, np.quantile((x - self.centre[j]) * np.sqrt(n), quantile))

    def predict(self, texts: list[np.ndarray]):
        """(language number or -1, score, entropy, rejected) of each text's codes."""
        if not texts or not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        xent, counts = self.entropies(texts)
        some = np.array([bool((c != SPACE).any()) for c in texts], dtype=bool)
        best = xent.argmin(axis=1)
        low = xent.min(axis=1)
        odds = np.exp(-(xent - low[:, None]) * np.clip(counts, 1, 64)[:, None])
        rejected = ~some | (low > self.centre[best] + self.spread[best] / np.sqrt(np.maximum(counts, 1)))
        return np.where(some, best, -1), np.where(some, 1 / odds.sum(axis=1), 0.0), low, rejected


def allowance(grams: list[int], most_each: int, most: int) -> int:
    """Grams a language may keep, of ``grams`` that they have, so that all keep no more than ``most`` together.

    What languages of few grams leave goes to the others."""
    left = most
    for i, n in enumerate(sorted(grams)):
        share = left // (len(grams) - i)
        if min(n, most_each) > share:
            return share
        left -= min(n, most_each)
    return most_each


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train: Column | None = None, order: int = 4, docs_per_language: int = 1500,
        grams_per_language: int = 300_000, most_languages: int = 10_000,
        most_grams: int = 4_000_000, quantile: float = 0.9995, slack: float = 1.0) -> Model:
    """Fit the models on about ``docs_per_language`` labelled documents of each language.

    All languages keep at most ``most_grams`` grams together; languages of few
    grams, such as stray labels, take nothing from the others but those.  Of a
    column of more than ``most_languages`` values the most frequent are learned.
    ``train`` says which rows may be learned from.  A fifth of the sample only
    calibrates the rejection (of languages with ``LEAST_APART`` documents; the others reject nothing).  Gram counts are summed in Spark; each language
    keeps its most frequent ones, at most ``grams_per_language``.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = (rows.where(train) if train is not None else rows).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    if not sizes:
        return Model({}, order)
    spark = docs.sparkSession
    known = spark.createDataFrame([(lang, threshold(docs_per_language / n), n >= LEAST_APART) for lang, n in sizes.items()],
                                  "lang string, below long, many boolean")
    # By the row's place too, so that copies and null ids are sampled row by row; of a language of few rows, all are learned.
    rows = rows.join(F.broadcast(known), "lang").where(
        F.xxhash64("doc_id", "text", F.monotonically_increasing_id(), F.lit(7)) <= F.col("below"))
    apart = F.col("many") & (F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(5)) == 0)

    def count(batches):
        from collections import Counter, defaultdict

        letters = Letters()
        for b in batches:
            grams = defaultdict(Counter)
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                s = " " * (order - 1) + letters(text).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
                grams[lang].update(s[i:i + order] for i in range(len(s) - order + 1))
            found = [(lang, g, c) for lang, counts in grams.items() for g, c in counts.items()]
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                names=["lang", "gram", "n"])

    counts = checkpointed(rows.where(~apart).select("lang", "text").mapInArrow(count, "lang string, gram string, n long")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # The least count at which a language has no more than its share of grams.
    steps = counts.groupBy("lang", "n").agg(F.count("*").alias("grams")).orderBy(F.desc("n")).collect()
    held, least = {}, {}
    for r in steps:
        held[r["lang"]] = held.get(r["lang"], 0) + r["grams"]
    share = allowance(list(held.values()), grams_per_language, most_grams)
    held = dict.fromkeys(held, 0)
    for r in steps:
        held[r["lang"]] += r["grams"]
        if held[r["lang"]] <= share:
            least[r["lang"]] = r["n"]
    few = spark.createDataFrame(list(least.items()), "lang string, least long")
    top = counts.join(F.broadcast(few), "lang").where(F.col("n") >= F.col("least")).select("lang", "gram", "n").toPandas()
    grams = {lang: dict(zip(part["gram"], part["n"])) for lang, part in top.groupby("lang")}
    model = Model(grams, order)
    if not grams:
        return model
    shared = spark.sparkContext.broadcast(model)

    def measure(batches):
        model, letters = shared.value, Letters()
        place = {lang: j for j, lang in enumerate(model.languages)}
        for b in batches:
            kept = [(lang, letters(t)) for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist())
                    if lang in place]
            xent, counts = model.entropies([codes for _, codes in kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, _ in kept], pa.string()),
                 pa.array([float(xent[i, place[lang]]) for i, (lang, _) in enumerate(kept)], pa.float64()),
                 pa.array(counts, pa.int64())], names=["lang", "entropy", "n"])

    measured = rows.where(apart).select("lang", "text").mapInArrow(measure, "lang string, entropy double, n long").collect()
    model.calibrate([(r["lang"], r["entropy"], r["n"]) for r in measured], quantile, slack)
    return model


def _predict(model: Model, letters: Letters, texts: list[str | None]) -> list[list]:
    """Columns (language number, score, entropy, rejected), a bounded number of characters at once."""
    out: list[list] = [[], [], [], []]
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < 4 * PIECE):
            size += len(texts[hi] or "")
            hi += 1
        for column, values in zip(out, model.predict([letters(t or "") for t in texts[lo:hi]])):
            column.extend(values.tolist())
        lo = hi
    return out


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        model, letters = shared.value, Letters()
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for b in batches:
            best, score, entropy, rejected = _predict(model, letters, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(names[np.array(best, dtype=int)], pa.string()), pa.array(score, pa.float64()),
                 pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return kept.mapInArrow(run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def accepted(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def change():
        model, letters = shared.value, Letters()
        return lambda batch, texts: batch.filter(pa.array([not r for r in _predict(model, letters, texts)[3]], pa.bool_()))

    return map_batches(docs, change, text_col=text_col)
