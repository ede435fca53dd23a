"""Toxicity by noisy-channel deobfuscation and a word scorer.

Words with digits, symbols or repeats between their letters, and words spelled
out letter by letter, are taken as a distorted form of a clean word.  Each
character becomes a column of a lattice: itself, the letters it may stand for,
or nothing.  A Viterbi pass over the lattice, under a character trigram model of
clean words, restores the word.  The document's distinct words, restored ones
included, are then scored by features (the word, its first letters) that
labelled documents mark as toxic, and the strongest words are calibrated to a
probability.

Defined results: a null or empty text has no word, so the score of a document
without any toxic sign; repeated rows are scored alike; a label null or absent
teaches nothing; of several labels for one document the larger counts; without
labels every score is 0; empty tables give no rows; whole texts are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpointed, delete_folder, shared_folder, text_docs

# The letters a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i",
    "*": "abcdefghijklmnopqrstuvwxyz", "#": "aeiou", "%": "aeiou", "?": "aeiou",
}
# Costs, as log probabilities, of the channel's steps.
SUBSTITUTED, WILDCARD = -1.0, -2.5
DROPPED_SEPARATOR, DROPPED_SYMBOL, DROPPED_DIGIT, DROPPED_REPEAT = -0.7, -4.0, -9.0, -0.5
WILD = "*#%?"
# Punctuation at the edges of a token that stands for no letter.
OPENING, CLOSING = frozenset(".,;:'\"()[]{}<>¿¡/\\-"), frozenset(".,;:'\"()[]{}<>?!/\\|-")
RUN = 3  # a run of one symbol this long at an edge is decoration
BOUNDARY = "\x02"
ALPHABET = BOUNDARY + "abcdefghijklmnopqrstuvwxyz"
MORE_LETTERS = 8  # other letters of a word up to which its wildcards are decoded with tables of all states
PARTS = re.compile(r"[^\W_]+")
REPEATS = re.compile(r"(\w)\1\1")
MEMO = 300_000
SUMMARY = 4  # strongest words of a document that count


class Spelling:
    """Character trigram model of clean words, interpolated with shorter histories."""

    def __init__(self, grams: dict[str, int], backing: float = 2.0):
        counts, heads = defaultdict(float), defaultdict(float)
        for g, n in grams.items():
            for k in range(3):
                counts[g[k:]] += n
                heads[g[k:-1]] += n
        self.counts, self.heads, self.backing = dict(counts), dict(heads), backing
        self.letters = max(2, len({g[-1] for g in grams}) + 1)
        self.memo: dict[tuple[str, str], float] = {}
        self.all = None

    def logp(self, head: str, letter: str) -> float:
        got = self.memo.get((head, letter))
        if got is None:
            p = 1.0 / self.letters
            for k in range(len(head), -1, -1):
                h = head[k:]
                p = (self.counts.get(h + letter, 0.0) + self.backing * p) / (self.heads.get(h, 0.0) + self.backing)
            got = self.memo[head, letter] = math.log(p)
        return got

    def table(self, letters: str) -> np.ndarray:
        """Log probability of each letter after each two letters; that of ``ALPHABET``, its first letters, is kept."""
        if letters == ALPHABET:
            if self.all is None:
                self.all = np.array([[[self.logp(a + b, c) for c in letters] for b in letters] for a in letters])
            return self.all
        out, k = np.empty((len(letters),) * 3), len(ALPHABET)
        out[:k, :k, :k] = self.table(ALPHABET)
        for i, a in enumerate(letters):
            for j, b in enumerate(letters):
                for n, c in enumerate(letters):
                    if max(i, j, n) >= k:
                        out[i, j, n] = self.logp(a + b, c)
        return out


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each character of a word: (letter or nothing, cost of the channel)."""
    columns = []
    for i, c in enumerate(word):
        column = [(c, 0.0)] if c.isalpha() else []
        column += [(x, WILDCARD if c in WILD else SUBSTITUTED) for x in STANDS_FOR.get(c, "")]
        if not c.isalpha():
            column.append(("", DROPPED_DIGIT if c.isdigit() else DROPPED_SYMBOL if c in STANDS_FOR else DROPPED_SEPARATOR))
        elif i and word[i - 1] == c:
            column.append(("", DROPPED_REPEAT))
        columns.append(column)
    return columns


def restore(word: str, spelling: Spelling) -> str:
    """The likeliest clean word behind a distorted one: exact Viterbi over the last two letters."""
    if sum(c in WILD for c in word) > 1:
        others = "".join(sorted({c for c in word if c.isalpha()} - set(ALPHABET)))
        if len(others) <= MORE_LETTERS:
            return _restore_dense(word, spelling, ALPHABET + others)
    best = {BOUNDARY * 2: (0.0, None)}
    for column in lattice(word):
        new: dict[str, tuple] = {}
        for state, (score, path) in best.items():
            for letter, cost in column:
                if letter:
                    to, now = state[1] + letter, score + cost + spelling.logp(state, letter)
                    way = (letter, path)
                else:
                    to, now, way = state, score + cost, path
                if to not in new or now > new[to][0]:
                    new[to] = (now, way)
        best = new
    _, path = max(((s + spelling.logp(state, BOUNDARY), p) for state, (s, p) in best.items()), key=lambda x: x[0])
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def _restore_dense(word: str, spelling: Spelling, letters: str) -> str:
    """The same with all states in one array, for words in which wildcards reach most of them."""
    step, place = spelling.table(letters), {c: i for i, c in enumerate(letters)}
    size = len(letters)
    score = np.full((size, size), -np.inf)
    score[0, 0] = 0.0
    ways = []  # for each character and state: the letter before the last two, or -1 where the character is dropped
    for column in lattice(word):
        cost, drop = np.full(size, -np.inf), -np.inf
        for letter, c in column:
            if letter:
                cost[place[letter]] = max(cost[place[letter]], c)
            else:
                drop = max(drop, c)
        on = np.flatnonzero(cost > -np.inf)
        new, way = score + drop, np.full((size, size), -1, dtype=np.int16)
        if len(on):
            came = score[:, :, None] + step[:, :, on]
            before = came.argmax(axis=0)
            reached = np.take_along_axis(came, before[None], axis=0)[0] + cost[on]
            better = reached > new[:, on]
            new[:, on] = np.where(better, reached, new[:, on])
            way[:, on] = np.where(better, before, -1)
        ways.append(way)
        score = new
    end = score + step[:, :, 0]
    b, c = np.unravel_index(int(end.argmax()), end.shape)
    out = []
    for way in reversed(ways):
        a = way[b, c]
        if a >= 0:
            out.append(letters[c])
            b, c = a, b
    return "".join(reversed(out))


def edge(token: str, marks: frozenset) -> int:
    """How many characters at the start of a token are punctuation or runs of a symbol."""
    at = 0
    while at < len(token):
        c = token[at]
        end = at + 1
        while end < len(token) and token[end] == c:
            end += 1
        if c in marks or end - at >= RUN and not c.isalnum() and c != "_":
            at = end
        else:
            break
    return at


def core_of(token: str) -> str:
    """A token without punctuation and decoration at its edges."""
    token = token[edge(token, OPENING):]
    return token[:len(token) - edge(token[::-1], CLOSING)]


def clean_words(token: str, spelling: Spelling | None) -> tuple[str, ...]:
    """The clean words of one lower-cased token; distorted ones restored where a spelling model is given."""
    if token.isalpha():
        if spelling and REPEATS.search(token):
            return token, restore(token, spelling)
        return (token,)
    core = core_of(token)
    if core.isalpha():
        return clean_words(core, spelling)
    parts = PARTS.findall(core)
    words = tuple(p for p in parts if p.isalpha() and len(p) > 1)
    letters = sum(map(str.isalpha, core))
    if spelling is None or not letters or letters < 2 <= len(core) - letters and not any(map(STANDS_FOR.get, core)):
        return words
    if all(p.isalpha() for p in parts) and not any(c in STANDS_FOR for c in core):
        # Only separators: words joined by them, unless each is a single letter.
        return words if any(len(p) > 1 for p in parts) or len(parts) < 3 else (*words, "".join(parts))
    return (*words, restore(core, spelling))


def spelled_out(tokens: list[str]) -> list[str]:
    """Runs of four or more one-character tokens, joined, with and without the first (it may be an article)."""
    sizes = bytes([2 if len(t) > 1 else 1 for t in tokens])
    runs = ["".join(tokens[m.start():m.end()]) for m in re.finditer(b"\x01{4,}", sizes)]
    return runs + [r[1:] for r in runs]


def distinct_tokens(text: str) -> set[str]:
    """All that a text's words come from: its lower-cased tokens, and what is spelled out letter by letter."""
    tokens = text.lower().split()
    return {*tokens, *spelled_out(tokens)}


class Words:
    """Distinct clean words of a text, remembering what tokens stand for."""

    def __init__(self, spelling: Spelling | None):
        self.spelling, self.memo = spelling, {}

    def of_token(self, token: str) -> tuple[str, ...]:
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[token] = clean_words(token, self.spelling)
        return got

    def __call__(self, text: str) -> set[str]:
        return self.of_tokens(distinct_tokens(text))

    def of_tokens(self, tokens) -> set[str]:
        out: set[str] = set()
        for token in tokens:
            out.update(self.of_token(token))
        return out


def features(word: str) -> list[str]:
    """The word as a whole, and its first letters."""
    return ["=" + word, *(word[:n] for n in (4, 5, 6, 7) if len(word) > n)]


class Scorer:
    """Feature weights, the spelling model, and the calibration."""

    def __init__(self, spelling: Spelling, weights: dict[str, float]):
        self.spelling, self.weights = spelling, weights
        self.coefficients = None  # of the strongest words, then the intercept

    def start(self) -> "Scorer":
        self.words, self.memo = Words(self.spelling), {}
        return self

    def strongest(self, tokens) -> list[float]:
        """The largest word weights of distinct tokens, falling, 0 where there is none; then the log of the distinct words."""
        memo, get = self.memo, self.weights.get
        found, words = [], self.words.of_tokens(tokens)
        for word in words:
            w = memo.get(word)
            if w is None:
                if len(memo) >= MEMO:
                    memo.clear()
                w = memo[word] = max([0.0, *(x for f in features(word) if (x := get(f)))])
            if w:
                found.append(w)
        return [*(heapq.nlargest(SUMMARY, found) + [0.0] * SUMMARY)[:SUMMARY], math.log(1 + len(words))]

    def calibrate(self, held: DataFrame) -> None:
        """Logistic regression by Newton's steps, with a small penalty, over (toxic, x) rows; each task adds up its rows for a step."""
        size = SUMMARY + 2
        held = checkpointed(held.groupBy("toxic", "x").agg(F.count("*").alias("n")))
        b = np.zeros(size)

        def sums(batches):
            total = np.zeros((size, size + 1))
            for batch in batches:
                y = np.array(batch.column("toxic").to_pylist(), dtype=np.float64)
                x = np.column_stack([batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1), np.ones(len(y))])
                p, n = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30))), batch.column("n").to_numpy()
                total[:, :-1] += (x * (n * p * (1 - p))[:, None]).T @ x
                total[:, -1] += x.T @ (n * (y - p))
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

        if held.isEmpty():
            return
        for _ in range(50):
            total = sum(np.array(r["sums"]) for r in held.mapInArrow(sums, "sums array<double>").collect()).reshape(size, size + 1)
            pull = 0.1 * b * (np.arange(size) < size - 1)
            step = np.linalg.solve(total[:, :-1] + 0.1 * np.eye(size), total[:, -1] - pull)
            b = b + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        self.coefficients = b

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.coefficients is None or not texts:
            return np.zeros(len(texts))
        x = np.array([self.strongest(distinct_tokens(t)) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients[:-1] + self.coefficients[-1], -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train: Column | None = None, least_docs: int = 3,
        most_features: int = 50_000) -> Scorer:
    """Fit on all labelled documents, a third of which only calibrates.

    ``train`` is a condition on the id column that says which rows may teach.
    The spelling model keeps the ``most_features`` most frequent letter trigrams,
    the scorer as many of the strongest features.  Documents meet their labels as
    distinct tokens, which are written once to the shared folder.
    """
    own = docs.where(F.col(id_col).isNotNull())
    own = own.where(train) if train is not None else own
    taught = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    taught = (taught.where(train) if train is not None else taught).groupBy(
        F.col(id_col).cast("long").alias("label_id")).agg((F.max(label_col) > 0).alias("toxic"))
    if taught.isEmpty():
        return Scorer(Spelling({}), {})

    def distinct(batches):
        for b in batches:
            tokens = [" ".join(distinct_tokens(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(tokens, pa.string())], names=["doc_id", "tokens"])

    kept = text_docs(own, id_col=id_col, text_col=text_col).mapInArrow(distinct, "doc_id long, tokens string")
    folder = shared_folder(docs.sparkSession, "labelled")
    (kept.join(taught, kept["doc_id"] == taught["label_id"])
     .select("tokens", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(3)) == 0).alias("held"))
     .write.parquet(folder))
    try:
        return _fit(docs.sparkSession.read.parquet(folder), least_docs=least_docs, most_features=most_features)
    finally:
        delete_folder(docs.sparkSession, folder)


def _fit(labelled: DataFrame, *, least_docs: int, most_features: int) -> Scorer:
    """Fit on (tokens, toxic, held) rows; held ones calibrate."""
    learn = labelled.where(~F.col("held"))

    def count_grams(batches):
        grams, words, held = Counter(), Words(None), Counter()

        def pass_on():
            for w, n in held.items():
                s = BOUNDARY * 2 + w + BOUNDARY
                for i in range(len(s) - 2):
                    grams[s[i:i + 3]] += n
            held.clear()

        for b in batches:
            for tokens in b.column("tokens").to_pylist():
                held.update(words.of_tokens(tokens.split()))
            if len(held) > MEMO:
                pass_on()
        pass_on()
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())],
                                         names=["gram", "n"])

    grams = (learn.mapInArrow(count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "gram").limit(most_features).collect())
    spelling = Spelling({r["gram"]: r["n"] for r in grams})

    def count_features(batches):
        words, counts = Words(spelling), (Counter(), Counter())

        def rows():
            names = list({*counts[0], *counts[1]})
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[0][f] for f in names], pa.int64()),
                 pa.array([counts[1][f] for f in names], pa.int64())], names=["feature", "clean", "toxic"])

        for b in batches:
            for tokens, toxic in zip(b.column("tokens").to_pylist(), b.column("toxic").to_pylist()):
                counts[bool(toxic)].update({f for w in words.of_tokens(tokens.split()) for f in features(w)})
                if len(counts[0]) + len(counts[1]) > MEMO:
                    yield rows()
                    counts[0].clear(), counts[1].clear()
        yield rows()

    sizes = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    odds = math.log((sizes.get(False, 0) + 1) / (sizes.get(True, 0) + 1))
    # How surely toxic documents hold the feature more often: the lower end of the log odds ratio.
    sure = (F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) + odds
            - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)))
    weights = (learn.mapInArrow(count_features, "feature string, clean long, toxic long")
               .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
               .where(F.col("toxic") >= least_docs).withColumn("weight", sure).where("weight > 0.5")
               .orderBy(F.desc("weight"), "feature").limit(most_features).collect())
    scorer = Scorer(spelling, {r["feature"]: r["weight"] for r in weights})

    def summarise(batches):
        ready = scorer.start()
        for b in batches:
            x = np.array([ready.strongest(t.split()) for t in b.column("tokens").to_pylist()]).reshape(-1, SUMMARY + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])

    scorer.calibrate(labelled.where("held").mapInArrow(summarise, "toxic boolean, x array<double>"))
    return scorer


def score_toxicity(docs: DataFrame, scorer: Scorer, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        ready = shared.value.start()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ready.scores(b.column("text").to_pylist()), pa.float64())],
                names=["doc_id", "score"])

    return text_docs(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id long, score double")
