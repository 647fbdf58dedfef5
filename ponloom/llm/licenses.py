"""Licenses in texts by conditional compression.

Candidate blocks are stretches of words around words that license wordings use. A block is compressed once alone and once with each
template as a raw dictionary; the bytes saved, against those that the template's own text saves, say how much of the template the
block holds. Every template that saves enough there is confirmed by its exact wording: its words are aligned with each stretch
of the block, and a stretch counts as found if at most a tenth of them, or none of a template shorter than ten words, are missing or have
others between. Both ends are free: a stretch begins and ends with words that agree, and has the fewest differences there are; of equals that with
more words agreeing, then the shorter one, then the first. What overlaps it is not another occurrence.

Null and empty texts have no blocks. A wording that occurs several times counts each time; of different wordings that overlap, that with more
words agreeing stays, of equals that with fewer differences. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, types as T

from ponloom.llm.frames import with_result
from ponloom.llm.license_texts import TEMPLATES

#: Words that mark a candidate block.
CUES = r"licen[cs]e[sd]?|copyright|redistributions?|permission|rights|warranty|warranties|unencumbered|spdx"
WORD = re.compile(r"\w+")
#: Rankings that a task remembers before it begins anew.
REMEMBERED = 1 << 14

RESULT = T.StructType([
    T.StructField("blocks", T.LongType()),
    T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("saved_share", T.DoubleType()), T.StructField("differences", T.LongType()),
        T.StructField("missing", T.ArrayType(T.StringType())), T.StructField("added", T.ArrayType(T.StringType())),
    ]))),
])


class Taken:
    """Stretches that do not overlap, kept in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> bool:
        """Take a stretch, if it overlaps none."""
        at = bisect_left(self.starts, start)
        if (at and self.ends[at - 1] > start) or (at < len(self.starts) and self.starts[at] < end):
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def _columns(wanted: list[str], span: list[str]) -> list[int]:
    """Longest common subsequences of a template with every prefix of a stretch, a bit a template word: a zero bit i
    says that one more word agrees with the template's first i + 1 words than with its first i."""
    every, places = (1 << len(wanted)) - 1, {}
    for i, w in enumerate(wanted):
        places[w] = places.get(w, 0) | 1 << i
    columns = [every]
    for w in span:
        row = columns[-1]
        same = row & places.get(w, 0)
        columns.append((row + same | row - same) & every)
    return columns


def stretches(wanted: list[str], span: list[str], begin: int, allowed: int) -> Iterator[tuple[int, int, int]]:
    """(differences, words agreeing, end) of the prefixes of a span with at most ``allowed`` differences that end with a word that agrees."""
    size, before = len(wanted), 0
    for j, row in enumerate(_columns(wanted, span)):
        agreeing = size - row.bit_count()
        if agreeing > before and max(size, j) - agreeing <= allowed:
            yield max(size, j) - agreeing, agreeing, begin + j
        before = agreeing


def differing(wanted: list[str], stretch: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that a stretch lacks, and those it has between."""
    columns, missing, added, i, j = _columns(wanted, stretch), [], [], len(wanted), len(stretch)
    while i or j:
        if i and j and wanted[i - 1] == stretch[j - 1]:
            i, j = i - 1, j - 1
        elif i and (not j or columns[j] >> i - 1 & 1):
            i -= 1
            missing.append(wanted[i])
        else:
            j -= 1
            added.append(stretch[j])
    return missing[::-1], added[::-1]


@dataclass
class Template:
    name: str
    words: list[str]
    with_dictionary: object
    best: int


class Scanner:
    """Templates as compressors. ``reach`` is how many words around a cue belong to its block, by the longest template."""

    def __init__(self, templates: dict[str, str], least_share: float = 0.25, tolerance: float = 0.1):
        self.least_share, self.tolerance = least_share, tolerance
        self.remembered: dict[str, list[tuple[float, Template]]] = {}
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.templates = []
        for name, text in sorted(templates.items()):
            found = WORD.findall(text.lower())
            raw = " ".join(found).encode()
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=3)
            compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=False)
            best = len(self.plain.compress(raw)) - len(compressor.compress(raw))
            self.templates.append(Template(name, found, compressor, max(best, 1)))
        self.reach = max((len(t.words) for t in self.templates), default=0)
        self.cue = re.compile(rf"(?:{CUES})")

    def blocks(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of words that reach a template's length around each cue, joined where they meet, cut where they are long."""
        out: list[list[int]] = []
        for k, word in enumerate(words):
            if self.cue.fullmatch(word):
                lo, hi = max(0, k - self.reach), min(len(words), k + self.reach + 1)
                if out and lo <= out[-1][1] and hi - out[-1][0] <= 8 * self.reach:
                    out[-1][1] = hi
                else:
                    out.append([lo, hi])
        return [(a, b) for a, b in out]

    def rank(self, words: list[str]) -> list[tuple[float, Template]]:
        """Templates by the share of their saving that a block attains, largest first. Blocks that repeat are remembered."""
        text = " ".join(words)
        if text not in self.remembered:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            raw = text.encode()
            alone = len(self.plain.compress(raw))
            shares = [((alone - len(t.with_dictionary.compress(raw))) / t.best, t) for t in self.templates]
            shares = [s for s in shares if s[0] >= self.least_share]
            self.remembered[text] = sorted(shares, key=lambda s: (-s[0] * s[1].best, s[1].name))
        return self.remembered[text]

    def wordings(self, words: list[str], template: Template) -> list[tuple[int, int, list[str], list[str]]]:
        """Every stretch of a block that has the template's wording but for few words: (start, end, missing, added)."""
        wanted, size = template.words, len(template.words)
        allowed = int(self.tolerance * size)
        if not allowed:
            first, at, out = wanted[0] if wanted else None, 0, []
            while at + size <= len(words) and size:
                if words[at] == first and words[at:at + size] == wanted:
                    out.append((at, at + size, [], []))
                    at += size
                else:
                    at += 1
            return out
        offers = [(differences, -agreeing, end - begin, begin) for begin in self._begins(words, wanted, allowed)
                  for differences, agreeing, end in stretches(wanted, words[begin:begin + size + allowed], begin, allowed)]
        out, taken = [], Taken()
        for _, _, length, begin in sorted(offers):
            if taken.add(begin, begin + length):
                out.append((begin, begin + length, *differing(wanted, words[begin:begin + length])))
        return sorted(out)

    @staticmethod
    def _begins(words: list[str], wanted: list[str], allowed: int) -> Iterator[int]:
        """Where a stretch can begin: at one of the template's first words, with enough of its words in reach, in whatever order."""
        first, lack, span = set(wanted[:allowed + 1]), Counter(wanted), len(wanted) + allowed
        common = 0
        for at in range(len(words) + span):
            # ``lack`` is how often a word of the template is still wanted in the span; below zero there are more than enough.
            if at < len(words) and words[at] in lack:
                common += lack[words[at]] > 0
                lack[words[at]] -= 1
            begin = at - span + 1
            if begin < 0:
                continue
            if begin >= len(words):
                return
            if words[begin] in first and common >= len(wanted) - allowed:
                yield begin
            if words[begin] in lack:
                lack[words[begin]] += 1
                common -= lack[words[begin]] > 0

    def scan(self, text: str) -> tuple[int, list[dict]]:
        lowered = text.lower()
        if not self.cue.search(lowered):
            return 0, []
        # Lower case can change the length of a few characters; offsets are those of the text itself.
        places = [(m.start(), m.end()) for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in places]
        blocks, found = self.blocks(words), []
        for lo, hi in blocks:
            block = words[lo:hi]
            # A small template's saving drowns in a large block, so the words next to each cue are ranked for themselves.
            near = {id(t): (share, t) for share, t in self.rank(block)}
            for k in (k for k in range(lo, hi) if self.cue.fullmatch(words[k])):
                for reach in (6, 12, 40):
                    for share, t in self.rank(words[max(lo, k - reach):min(hi, k + reach + 1)]):
                        if share > near.get(id(t), (0.0,))[0]:
                            near[id(t)] = (share, t)
            for share, t in near.values():
                for a, b, missing, added in self.wordings(block, t):
                    found.append((len(t.words) - len(missing), lo + a, lo + b, t.name, share, missing, added))
        kept, taken = [], Taken()
        for f in sorted(found, key=lambda f: (-f[0], max(len(f[5]), len(f[6])), f[1], f[3], -f[4])):
            if taken.add(f[1], f[2]):
                kept.append(f)
        rows = [{
            "license": name, "start": places[a][0], "end": places[b - 1][1], "saved_share": min(share, 1.0),
            "differences": max(len(missing), len(added)), "missing": list(missing), "added": list(added),
        } for _, a, b, name, share, missing, added in sorted(kept, key=lambda f: f[1])]
        return len(blocks), rows


def scan(docs: DataFrame, templates: dict[str, str] | None = None, text_col: str = "text", name: str = "licenses") -> DataFrame:
    """Add a struct: the number of candidate blocks, and each wording found with its place in the text and its differences."""
    wanted = TEMPLATES if templates is None else templates

    def compute(column: pa.Array) -> dict:
        if not scanner:
            scanner.append(Scanner(wanted))
        results = [scanner[0].scan(t.as_py() or "") for t in column]
        return {"blocks": [r[0] for r in results], "found": [r[1] for r in results]}

    scanner: list[Scanner] = []
    return with_result(docs, text_col, name, RESULT, compute)
