"""Language of whole texts, words first, with back-off to shorter and shorter character n-grams.

A known word scores by its log frequency in each language. A word that was never seen is scored by its character
n-grams, word borders included: by those of 5 characters that are known, or if none is by those of 4, and so on.
Words of a language are its runs of letters, digits and characters beyond ASCII, in lower case.

Texts that are null or have no letter get ``und`` with score 0. Texts with letters always get a learned language,
or ``und`` where nothing was learned. Repeated rows get equal results; of languages that tie the first by name wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ponloom.llm.frames import labelled_rows, with_result
from ponloom.llm.words import Lookup, mix, words
from ponloom.operators.lineage import stored

LONGEST = 5
#: Fixed value: weights of n-grams are whole numbers of this part, so that their sums do not depend on the order.
UNIT = 1 << 20
#: Fixed value: scores of words by language that are held at once.
CELLS = 1 << 20
UNDETERMINED = "und"
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known_words", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("evidence", T.LongType())])


def n_grams(joined: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of words framed by spaces, and the word of each."""
    framed = [f" {w} " for w in joined]
    sizes = np.array([len(w) for w in framed], np.int64)
    code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(framed)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))
    at = np.flatnonzero(left >= n)
    h = np.full(len(at), np.uint64(n))
    for k in range(n):
        h = h * np.uint64(0x100000001B3) + code[at + k]
        h ^= h >> np.uint64(29)
    return mix(h), word[at]


def log_rates(counts: np.ndarray, smooth: float) -> np.ndarray:
    """Log frequency of each row in each language, with added mass for what a language was not seen to have."""
    totals = counts.sum(0, keepdims=True)
    return np.log((counts + smooth) / (totals + smooth * len(counts) + 1)).astype(np.float32)


@dataclass
class Rates:
    """Log frequencies as ``log_rates`` gives them, kept only where a count is not 0; ``rates[rows]`` gives whole rows.

    ``none`` is what each language has for a count of 0; row ``i`` has the entries ``start[i]:start[i + 1]``.
    """

    none: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    rate: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, lang: np.ndarray, n: np.ndarray, rows: int, langs: int, smooth: float) -> Rates:
        """From counts ordered by row."""
        totals = np.bincount(lang, n, langs) + smooth * rows + 1
        rate = np.log((n + smooth) / totals[lang]).astype(np.float32)
        return cls(np.log(smooth / totals).astype(np.float32), np.searchsorted(row, np.arange(rows + 1)), lang, rate)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.tile(self.none, (len(rows), 1))
        size = self.start[rows + 1] - self.start[rows]
        entry = np.arange(size.sum()) + np.repeat(self.start[rows] - np.cumsum(size) + size, size)
        out[np.repeat(np.arange(len(rows)), size), self.lang[entry]] = self.rate[entry]
        return out


@dataclass
class Model:
    """Languages, word rows and n-gram rows by length."""

    langs: list[str]
    keys: np.ndarray
    rates: Rates | np.ndarray
    gram_keys: dict[int, np.ndarray]
    gram_rates: dict[int, Rates | np.ndarray]
    tables: dict = field(default_factory=dict, repr=False)

    def table(self, n: int) -> Lookup:
        if n not in self.tables:
            self.tables[n] = Lookup(self.gram_keys[n] if n else self.keys)
        return self.tables[n]

    def resembling(self, texts: list[str]) -> np.ndarray:
        """Which unseen words share a character with a learned word: without one no n-gram is known but the border."""
        grams, word = n_grams(texts, 1)
        border = n_grams([""], 1)[0][0]
        return np.bincount(word[(self.table(1)(grams) >= 0) & (grams != border)], minlength=len(texts)) > 0

    def unseen(self, texts: list[str]) -> np.ndarray:
        """Scores of unseen words: the mean log frequency of the longest n-grams that are known, 0 where none is."""
        out = np.zeros((len(texts), len(self.langs)), np.float64)
        todo = np.arange(len(texts))
        for n in range(LONGEST, 0, -1):
            if not len(todo):
                break
            grams, word = n_grams([texts[i] for i in todo], n)
            row = self.table(n)(grams)
            hit = row >= 0
            if not hit.any():
                continue
            found, first, count = np.unique(word[hit], return_index=True, return_counts=True)
            out[todo[found]] = np.add.reduceat(self.gram_rates[n][row[hit]].astype(np.float64), first, axis=0) / count[:, None]
            todo = np.delete(todo, found)
        return out


def _sums(batch_lang: np.ndarray, hashes: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair of language and hash is first, and how often it is there or the sum of its ``n``."""
    pairs = hashes ^ mix(batch_lang.astype(np.uint64) + np.uint64(7))
    _, first, at, count = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
    return first, count.astype(np.int64) if n is None else np.bincount(at, n, len(first)).astype(np.int64)


def _count_words(sample: DataFrame) -> DataFrame:
    """(lang, word, key, n) of a sample with numbers for languages. Lower case is that of ``identify``."""

    def run(batches):
        for batch in batches:
            lang = batch.column(1).to_numpy()
            for lo, hi, w in words(pc.utf8_lower(batch.column(0))):
                doc_lang = np.repeat(lang[lo:hi], np.diff(w.offsets))
                first, count = _sums(doc_lang, w.hashes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_lang[first], pa.int32()), pa.array([w.text(k) for k in first], pa.string()),
                    pa.array(w.hashes[first].view(np.int64)), pa.array(count),
                ], names=["lang", "word", "key", "n"])

    counted = sample.select("text", "lang").mapInArrow(run, "lang int, word string, key long, n long")
    return counted.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _count_grams(counted: DataFrame) -> DataFrame:
    """(size, lang, key, n): n-grams of words, weighted by the root of the words' counts."""

    def run(batches):
        for batch in batches:
            texts, lang = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            weight = np.rint(np.sqrt(batch.column(2).to_numpy()) * UNIT)
            for size in range(1, LONGEST + 1) if texts else ():
                grams, word = n_grams(texts, size)
                first, n = _sums(lang[word], grams, weight[word])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(first), size, np.int32)), pa.array(lang[word[first]], pa.int32()), pa.array(grams[first].view(np.int64)), pa.array(n),
                ], names=["size", "lang", "key", "n"])

    return counted.select("word", "lang", "n").mapInArrow(run, "size int, lang int, key long, n long")


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 2000, min_count: int = 3, id_col: str | None = None,
) -> Model:
    """Learn every language that is not null from a sample of about ``per_lang`` of its documents.

    All words of the sample seen at least ``min_count`` times are learned; twice in one language suffices for the n-grams. Words and n-grams
    are counted in tasks; the driver gets a row of 17 bytes for each that a language has, and languages are joined, so there may be many.
    With ``id_col`` the sample is chosen by document, else by text, all copies or none.
    """
    rows = labelled_rows(labelled, F.col(text_col), F.col(lang_col), id_col).filter("text IS NOT NULL AND label IS NOT NULL")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    empty = {n: np.zeros(0, np.uint64) for n in range(1, LONGEST + 1)}
    if not counts:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), empty, {})
    langs = sorted(counts)
    codes = rows.sparkSession.createDataFrame([(lang, k, per_lang / counts[lang]) for k, lang in enumerate(langs)], "label string, lang int, share double")
    pick = F.col("pick").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    sample = rows.join(F.broadcast(codes), "label").filter(pick < F.col("share")).select("text", "lang")
    counted = stored(_count_words(sample).filter(F.col("n") >= 2), "language-words")
    found = counted.select(F.lit(0).alias("size"), "lang", "key", "n").union(_count_grams(counted))
    total = F.sum("n") / F.when(F.col("size") == 0, 1).otherwise(UNIT)
    table = found.groupBy("size", "lang", "key").agg(total.cast("float").alias("n")).withColumn("size", F.col("size").cast("byte")).toArrow()
    made = {}
    for size in range(LONGEST + 1):
        some = table.filter(pc.equal(table["size"], size))
        lang, n = some["lang"].to_numpy(), some["n"].to_numpy().astype(np.float64)
        keys, row = np.unique(some["key"].to_numpy().view(np.uint64), return_inverse=True)
        often = np.bincount(row, n, len(keys)) >= (0 if size else min_count)
        order = np.lexsort((lang, row))
        order = order[often[row[order]]]
        place = np.cumsum(often) - 1
        made[size] = keys[often], Rates.of(place[row[order]], lang[order], n[order], int(often.sum()), len(langs), 0.1)
    grams = range(1, LONGEST + 1)
    return Model(langs, *made[0], {n: made[n][0] for n in grams}, {n: made[n][1] for n in grams})


def identify(docs: DataFrame, model: Model, text_col: str = "text", name: str = "language") -> DataFrame:
    """Add a struct: the language, its probability among the learned ones, how many words were known, how many there are, and
    how many were known or share a character with a learned word (``evidence``); without evidence the language is a guess.
    """

    def compute(column: pa.Array) -> dict:
        column = pc.utf8_lower(column)
        letter = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)
        n, k = len(column), max(1, len(model.langs))
        total, known, sizes, evidence = np.zeros((n, k)), *np.zeros((3, n), np.int64)
        for lo, hi, w in words(column) if model.langs else ():
            row, sizes[lo:hi] = model.table(0)(w.hashes), np.diff(w.offsets)
            doc = np.repeat(np.arange(lo, hi), sizes[lo:hi])
            known[lo:hi] = np.bincount(doc[row >= 0] - lo, minlength=hi - lo)
            step = max(1, CELLS // k)
            for a in range(0, len(row), step):
                here = row[a:a + step]
                hit = here >= 0
                # Single precision: sums of such values in double are exact for any number of words that a text can have.
                value = np.zeros((len(here), k), np.float32)
                value[hit] = model.rates[here[hit]]
                if not hit.all():
                    _, first, back = np.unique(w.hashes[a:a + step][~hit], return_index=True, return_inverse=True)
                    texts = [w.text(a + i) for i in np.flatnonzero(~hit)[first]]
                    value[~hit] = model.unseen(texts)[back]
                    hit[~hit] = model.resembling(texts)[back]
                evidence[lo:hi] += np.bincount(doc[a:a + step][hit] - lo, minlength=hi - lo)
                docs_here, at = np.unique(doc[a:a + step], return_index=True)
                total[docs_here] += np.add.reduceat(value, at, axis=0, dtype=np.float64)
        best = total.argmax(1)
        odds = np.exp(total - total.max(1, keepdims=True))
        score = odds[np.arange(n), best] / odds.sum(1)
        names = np.asarray([*model.langs, UNDETERMINED], dtype=object)
        sure = letter & bool(model.langs)
        return {
            "lang": names[np.where(sure, best, len(names) - 1)].tolist(), "score": np.where(sure, score, 0.0),
            "known_words": known, "n_words": sizes, "evidence": evidence,
        }

    return with_result(docs, text_col, name, RESULT, compute)
