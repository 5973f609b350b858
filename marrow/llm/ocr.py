"""Repair of text that was read from scanned pages.

Page matter goes first: running headers (lines that hold, up to misread characters, one of
the known names of the issuing laboratories or the report's own id, and short lines that
stand beside page matter on several pages) and page numbers. Words broken at a line's end are
joined across page matter where the joined word is known and the hyphenated one is not.
Misread words are then decoded by a noisy channel: a word gets those corpus words as
candidates that character confusions lead to and that are far more frequent, and Viterbi
picks the likeliest sequence of a line from confusion probabilities times corpus bigram
likelihood. The probability of each confusion is estimated from the corpus, from the
occurrences of words with one candidate over the chances to misread. A word's own
occurrences speak for it only as far as they exceed what misreadings of its candidates
explain.

Nothing that grows with the corpus is broadcast or gathered, and no count is left out: word
and bigram counts and the doubtful words stay tables. A Bloom filter of fixed size tells
which words of a text may be doubtful; only the lines with such a word or a break leave the
scan, and the counts they need are joined to them. A word that the filter lets through by
chance has no candidates after the join.

Limits: a heading holds at most ``NAME_LINE`` characters and ``NAME_SPARE`` besides the name
(``OWN_LINE`` and ``OWN_SPARE`` with the report's id); runs of more than ``LONGEST_WORD``
signs are no words.

Defined cases: null, empty and blank texts have no noise and stay as they are; texts of
any length are read whole; repeated rows are treated each for itself; both line ends are
understood, lines are counted at "\\n".
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marrow.operators.bounded import collect_bounded
from marrow.session import cut, once, spread

MAX_NAMES = 10_000
#: Words a Python worker gathers before it counts them.
FLUSH = 3_000_000
#: A word this many times rarer than a word it may be a misreading of is suspect.
SUSPECT = 30
#: Words seen less often are sought two confusions away, too, if they have ``LONG_ENOUGH`` letters and no nearer candidate.
RARE, LONG_ENOUGH = 3, 5
LONGEST_WORD = 60
#: Characters of a heading's line and besides what makes it one: with the report's id, and with a name.
OWN_LINE, OWN_SPARE, NAME_LINE, NAME_SPARE = 200, 60, 120, 45
#: Pages on which a line of no known name must stand to be a heading, and their share of all.
LEAST_PAGES, MOST_PAGES = 3, 0.75
#: Lines after a break within which its word may go on, up to the first that begins in lower case; what stands between is page matter.
REACH = 8
#: Bits of the filter of doubtful words, two for each word.
FILTER_BITS = 1 << 26
#: Words a Python worker remembers as trusted.
REMEMBER = 300_000
#: What is seen, and what it may have been, as optical confusions go.
CONFUSIONS = {
    "c": "eoa", "l": "i1It", "α": "a", "5": "sS", "f": "t", "0": "oOD", "ri": "n", "|": "lIitT", "1": "liI", "cl": "d", "ii": "uü",
    "rn": "m", "9": "gq", "li": "h", "6": "béóGe", "F": "E", "ﬁ": ("fi",), "ﬂ": ("fl",), "vv": "w", "h": ("li", "b"), "4": "A", "O": "DQ0", "8": "B",
    "2": "Zz", "I": "l1", "i": "lj", "o": "ce", "e": "co", "t": "fr", "m": ("rn",), "d": ("cl",), "n": ("ri", "u"), "u": ("ii", "v", "n"), "v": "yu",
    "B": "8R", "S": "5", "3": "eB", "7": "T", "y": "v", "w": ("vv",), "E": "F", "D": "O", "G": "C6", "C": "G", "q": "g", "g": "q9", "r": "t", "ë": "é", "è": "é", "a": "oα", "s": "5",
}
#: Chance of a confusion before any evidence, and the weight of that in chances.
PRIOR, PRIOR_WEIGHT = 1e-3, 1000
#: Logarithms of the chance that a digit is misread, and that a word is read right.
MISREAD_DIGIT, RIGHT = math.log(1e-2), math.log(0.98)
#: Count of a word that no occurrence speaks for.
UNSEEN = 2e-4
_BREAK = "-‐‑­¬"
_EDGES = ".,:;()[]{}\"“”„«»?!…-‐‑­¬–"
_PAGE = re.compile(
    r"[\s~()\[\]<>|*.–—-]*(?:(?:[pP](?:a[gq][eo]|ag\.?|g\.?|ág(?:ina|\.)?|\.)|P[aα][gq9][ec]|[Ss]eite|[Ss]\.|[Bb]latt|[Hh]oja|[Ff]euille)\s*)?"
    r"[\dlIO|]{1,4}(?:\s*(?:/|\||of|von|sur|de|aus)\s*[\dlIO|]{1,4})?[\s~()\[\]<>|*.–—-]*"
)
_BARE = re.compile(r"\s*[\dlIO|]{1,4}\s*")
_NUMBER = re.compile(r"(?=.*\d)(?=.*[lIO|])[\dlIO|]+(?:[.,][\dlIO|]+)?")
_WORD = re.compile(r"[^\W\d_]{2}")
_DIGIT = re.compile(r"\d").search


def _real(line: str) -> str:
    return line[:-1] if line.endswith("\r") else line


class Pages:
    """Finds page matter; made once per Python worker from the laboratories' names."""

    def __init__(self, names: list[str]):
        self.names = sorted({n.strip().lower() for n in names if n and len(n.strip()) >= 6}, key=len, reverse=True)
        parts: dict[str, list[tuple[int, int]]] = {}
        for k, name in enumerate(self.names):
            for m in re.finditer(r"\S+", name):
                w = m.group()
                if len(w) >= 5:
                    half = len(w) // 2 if len(w) >= 8 else 0
                    for a, b in ((0, half), (half, len(w))) if half else ((0, len(w)),):
                        parts.setdefault(w[a:b], []).append((k, m.start() + a))
        self.parts = parts
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for part in parts:
            self.automaton.add_word(part, part)
        if parts:
            self.automaton.make_automaton()

    def headers(self, lines: list[str], own_id: str | None) -> set[int]:
        """Lines that hold a known name or the own id, up to misread characters, and little besides."""
        out: set[int] = set()
        short = [i for i, x in enumerate(lines) if 5 < len(x) <= OWN_LINE]
        low = [lines[i].strip().lower() for i in short]
        whole = "\n".join(low)
        if own_id and len(own_id) >= 8:
            own = own_id.lower()
            if own in whole:
                out |= {i for i, x in zip(short, low, strict=True) if own in x and len(x) - len(own) <= OWN_SPARE}
            least, most = len(own) - 1, len(own) + 4
            out |= {i for i, x in zip(short, low, strict=True) if least <= len(x) <= most and _DIGIT(x) and self._is_id(x, own)}
        if self.parts:
            starts = None
            for end, part in self.automaton.iter(whole):
                if starts is None:
                    starts = [0, *itertools.accumulate(len(x) + 1 for x in low)]
                k = bisect_right(starts, end) - 1
                if short[k] not in out and len(low[k]) <= NAME_LINE and self._named(low[k], end - starts[k], part):
                    out.add(short[k])
        return out

    def _named(self, line: str, end: int, part: str) -> bool:
        spare = len(line)
        for k, offset in self.parts[part]:
            name = self.names[k]
            at = end + 1 - len(part) - offset
            if at >= 0 and spare - len(name) <= NAME_SPARE and line.startswith(name, at):
                return True
            for shift in (0, -1, 1):
                a = max(0, at + shift)
                seen = line[a : a + len(name)]
                if len(seen) >= len(name) - 2 and spare - len(name) <= NAME_SPARE and sum(x != y for x, y in zip(seen, name, strict=False)) + abs(len(name) - len(seen)) <= 0.25 * len(name):
                    return True
        return False

    @staticmethod
    def _is_id(line: str, own_id: str) -> bool:
        """The id alone, with up to two misread characters."""
        spare = len(line) - len(own_id)
        return -1 <= spare <= 4 and any(sum(x != y for x, y in zip(line[a:], own_id, strict=False)) <= 2 for a in range(max(spare, 0) + 1))

    def find(self, lines: list[str], own_id: str | None) -> dict[int, str]:
        """Index of each line of page matter, and which kind it is."""
        out = dict.fromkeys(self.headers(lines, own_id), "running_header")
        marked, bare = [], []
        for i, line in enumerate(lines):
            s = line.strip()
            if 0 < len(s) <= 24 and i not in out and _PAGE.fullmatch(s) and any(c in "0123456789lIO|" for c in s):
                (bare if _BARE.fullmatch(s) else marked).append(i)
        for i in marked:
            out[i] = "page_number"
        if bare and not marked:
            page = 0
            for k, i in enumerate(bare):
                j = i - 1
                while j >= 0 and (j in out or not lines[j].strip()):
                    j -= 1
                before = lines[j].strip() if j >= 0 else ""
                value = before.endswith(":") and before != before.upper()
                number = re.sub(r"[lI|]", "1", lines[i].strip()).replace("O", "0")
                n = int(number) if number.isdigit() else -1
                if value:
                    # a label waits for its value; a page number may stand between
                    after = i + 1
                    while after < len(lines) and (after in out or not lines[after].strip()):
                        after += 1
                    if not (k + 1 < len(bare) and bare[k + 1] == after and n == page + 1):
                        continue
                if n > page and n - page <= 3:
                    out[i] = "page_number"
                    page = n
        for i in self.repeated(lines, out):
            out[i] = "running_header"
        return out

    @staticmethod
    def repeated(lines: list[str], matter: dict[int, str]) -> list[int]:
        """Short lines that stand beside page matter on most pages and nowhere else, whatever their digits."""
        if len(matter) < LEAST_PAGES:
            return []
        shown = [i for i, x in enumerate(lines) if x.strip()]
        pages = sum(i in matter and not (k and shown[k - 1] in matter) for k, i in enumerate(shown))
        beside: dict[str, list[int]] = defaultdict(list)
        elsewhere: set[str] = set()
        for k, i in enumerate(shown):
            if i not in matter and len(lines[i]) <= NAME_LINE:
                letters = "".join(c for c in lines[i].lower() if c.isalpha())
                if k in (0, len(shown) - 1) or shown[k - 1] in matter or shown[k + 1] in matter:
                    beside[letters].append(i)
                else:
                    elsewhere.add(letters)
        return [i for letters, found in beside.items() if len(letters) >= 8 and letters not in elsewhere and len(found) >= max(LEAST_PAGES, MOST_PAGES * pages) for i in found]


def once_confused(word: str, table: list[tuple[str, tuple[str, ...]]]) -> dict[str, str]:
    """Words one entry of ``table`` away, and the entry as "seen>true"; the first one where several lead there."""
    out: dict[str, str] = {}
    for seen, trues in table:
        at = word.find(seen)
        while at >= 0:
            for true in trues:
                out.setdefault(word[:at] + true + word[at + len(seen) :], f"{seen}>{true}")
            at = word.find(seen, at + 1)
    return out


FORWARD = [(s, tuple(t)) for s, t in CONFUSIONS.items()]
_BACK: dict[str, list[str]] = defaultdict(list)
for _s, _t in FORWARD:
    for _x in _t:
        _BACK[_x].append(_s)
#: The same table from what was written to what may be seen.
BACKWARD = [(t, tuple(s)) for t, s in _BACK.items()]


def is_number(word: str) -> bool:
    return len(word) <= LONGEST_WORD and _NUMBER.fullmatch(word) is not None


def as_number(word: str) -> str:
    return re.sub(r"[lI|]", "1", word).replace("O", "0")


def _parts(line: str, following: str) -> tuple[str, str, re.Match[str], str] | None:
    """(left, right, match of the next line's first word, last word) of a word broken between two lines."""
    line = line.rstrip()
    if len(line) < 2 or line[-1] not in _BREAK or not line[-2].isalpha():
        return None
    tail = re.search(r"\S+$", line).group()
    head = re.match(r"\s*(\S+)", following)
    if not head or not head.group(1)[0].isalpha():
        return None
    return tail.rstrip(_BREAK).lstrip(_EDGES), head.group(1).strip(_EDGES), head, tail


def count_words(df: DataFrame, text: str) -> DataFrame:
    """(a, b, n): counts of words (b is null) and of pairs of neighbours in a line, over all texts.

    Words that line breaks would join come with a count of 0 besides their own.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        held: list[np.ndarray] = []
        joined: set[str] = set()
        size = 0

        def flush() -> pd.DataFrame:
            # words are counted as they stand and stripped once each
            plain = np.array([w.strip(_EDGES) for w in ids] or [""], dtype=object)
            n = np.bincount(np.concatenate(held), minlength=len(plain)) if held else np.zeros(len(plain), np.int64)
            pairs, m = np.unique(np.concatenate([x[:-1] << 32 | x[1:] for x in held] or [np.zeros(0, np.int64)]), return_counts=True)
            none = np.full(len(plain) + len(joined), None, dtype=object)
            extra = np.array([*joined], dtype=object)
            out = pd.DataFrame({"a": np.concatenate([plain, extra, plain[pairs >> 32]]), "b": np.concatenate([none, plain[pairs & 0xFFFFFFFF]]), "n": np.concatenate([n, np.zeros(len(extra), np.int64), m])})
            held.clear()
            joined.clear()
            return out

        for batch in batches:
            for value in batch["text"]:
                words = value.split()
                if words:
                    held.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
                    size += len(words)
                if _ENDS.search(value):
                    lines = [x for x in value.split("\n") if x.strip()]
                    for i, line in enumerate(lines):
                        if line.rstrip()[-1] in _BREAK:
                            for following in lines[i + 1 : i + 1 + REACH]:
                                if parts := _parts(line, following):
                                    joined.update((parts[0] + parts[1], parts[0] + "-" + parts[1]))
                                if following.lstrip()[:1].islower():
                                    break
                if size > FLUSH or len(joined) > FLUSH:
                    yield flush()
                    size = 0
                    ids = defaultdict(itertools.count().__next__)
        if held:
            yield flush()

    counted = spread(df.select(F.col(f"`{text}`").alias("text"))).where("text is not null").mapInPandas(count, "a string, b string, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n")).where("a != ''")


_ENDS = re.compile(rf"[{_BREAK}][^\S\n]*\n")


def filter_bits(df: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a column's strings: at most ``FILTER_BITS`` / 64 rows reach the driver, whatever the size of ``df``."""
    h = F.xxhash64(column)
    at = F.explode(F.array(h.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(FILTER_BITS - 1))))
    bits = df.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64).view(np.uint64)
    return out


class Filter:
    """Test of ``filter_bits`` in a worker."""

    def __init__(self, bits: np.ndarray):
        import xxhash

        self.bits, self.hash = bits.view(np.uint8), xxhash.xxh64_intdigest

    def __contains__(self, word: str) -> bool:
        h = self.hash(word.encode("utf-8", "surrogatepass"), 42)
        a, b = h & FILTER_BITS - 1, h >> 32 & FILTER_BITS - 1
        return bool(self.bits[a >> 3] >> (a & 7) & 1 and self.bits[b >> 3] >> (b & 7) & 1)


def _variants(words: DataFrame, table: list[tuple[str, tuple[str, ...]]], wanted: object = None) -> DataFrame:
    """(w, n, v, c): every word one confusion away from each word, as far as the filter ``wanted`` lets it through."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = once(wanted, Filter) if wanted is not None else None
        for batch in batches:
            rows = [(w, n, v, c) for w, n in zip(batch["w"], batch["n"], strict=True) for v, c in once_confused(w, table).items() if known is None or v in known]
            yield pd.DataFrame(rows, columns=["w", "n", "v", "c"])

    return words.select("w", "n").mapInPandas(each, "w string, n long, v string, c string")


class Corpus:
    """Counts of one corpus, its doubtful words with their candidates, and the filter of them."""

    def __init__(self, df: DataFrame, text: str = "text"):
        counts = cut(count_words(df, text))
        self.pairs = counts.where("b is not null")
        self.words = counts.where("b is null").select(F.col("a").alias("w"), "n")
        self.total = int(self.words.agg(F.sum("n")).first()[0] or 0)
        letters = F.col("w").rlike(r"(?U)[^\W\d_]")
        number = F.col("w").rlike(r"^(?=.*\d)(?=.*[lIO|])[\dlIO|]+([.,][\dlIO|]+)?$")
        usable = self.words.where((F.char_length("w") <= LONGEST_WORD) & letters & ~number & ((F.char_length("w") >= 3) | (F.col("n") == 0)))
        true = self.words.where(F.col("w").rlike(r"(?U)[^\W\d_]{2}")).select(F.col("w").alias("v"), F.col("n").alias("n_v"))
        enough = lambda times: F.col("n_v") >= F.greatest(F.col("n").cast("double"), F.lit(0.1)) * SUSPECT * times
        sc = df.sparkSession.sparkContext
        frequent = sc.broadcast(filter_bits(true.where(F.col("n_v") >= 0.1 * SUSPECT), "v"))
        near = cut(_variants(usable, FORWARD, frequent).where("v != w").join(true, "v").where(enough(1)).select("w", "n", "v", "n_v", F.array("c").alias("c")))
        # two confusions away: one step from the rare word and one back from the frequent one meet in between
        rare = usable.where((F.col("n") < RARE) & (F.char_length("w") >= LONG_ENOUGH)).join(near.select("w").distinct(), "w", "left_anti")
        back = _variants(true.where(F.col("n_v") >= 0.1 * SUSPECT * 3).select(F.col("v").alias("w"), F.col("n_v").alias("n")), BACKWARD).select(F.col("w").alias("v"), F.col("n").alias("n_v"), F.col("v").alias("u"), F.concat(F.substring_index("c", ">", -1), F.lit(">"), F.substring_index("c", ">", 1)).alias("c2"))
        met = sc.broadcast(filter_bits(back := cut(back), "u"))
        far = _variants(rare, FORWARD, met).select("w", "n", F.col("v").alias("u"), "c").join(back, "u").where(enough(3) & (F.col("v") != F.col("w"))).groupBy("w", "v").agg(F.first("n").alias("n"), F.first("n_v").alias("n_v"), F.min(F.array("c", "c2")).alias("c"))
        self.chances = self._chances(near)
        chance = F.create_map(*[F.lit(x) for kv in self.chances.items() for x in kv])
        found = near.unionByName(far.select("w", "n", "v", "n_v", "c")).withColumn("p", F.aggregate("c", F.lit(1.0), lambda a, x: a * F.coalesce(chance[x], F.lit(PRIOR))))
        explained = F.sum(F.col("n_v") * F.col("p"))
        doubtful = found.groupBy("w").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct((-F.col("n_v")).alias("order"), "v", "n_v", F.log("p").alias("p")))).alias("options"), explained.alias("e"))
        # misreadings come in clumps, such as reports delivered twice
        left = F.greatest(F.col("n") - (3 * F.col("e") + 6 * F.sqrt("e") + 2), F.lit(0.0))
        self.doubtful = cut(doubtful.select("w", F.transform("options", lambda x: F.struct(x["v"].alias("v"), x["n_v"].alias("n"), x["p"].alias("p"))).alias("options"), F.coalesce(F.try_divide(left, F.col("n").cast("double")), F.lit(0.0)).alias("share")))

    def _chances(self, near: DataFrame) -> dict[str, float]:
        """Chance of each confusion: misread occurrences of words with one candidate, over the chances to misread."""
        alone = near.groupBy("w").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"), F.first(F.get("c", F.lit(0))).alias("c")).where("k = 1 and n > 0")
        hits = {r["c"]: r["n"] for r in alone.groupBy("c").agg(F.sum("n").alias("n")).collect()}  # one row an entry of the table
        trues = sorted({t for _, ts in FORWARD for t in ts})
        # occurrences in a word: what the length loses without them
        occurs = [F.sum(F.col("n") * (F.char_length("w") - F.char_length(F.replace("w", F.lit(t), F.lit("")))) / len(t)).alias(f"t{i}") for i, t in enumerate(trues)]
        row = self.words.agg(*occurs).first()
        chances = {t: row[f"t{i}"] or 0.0 for i, t in enumerate(trues)}
        return {f"{s}>{t}": (hits.get(f"{s}>{t}", 0) + PRIOR * PRIOR_WEIGHT) / (chances[t] + PRIOR_WEIGHT) for s, ts in FORWARD for t in ts}

    def filter(self) -> np.ndarray:
        """Filter of the doubtful words."""
        return filter_bits(self.doubtful, "w")


class Channel:
    """Noisy channel over what is known of the words of a few lines.

    ``words`` gives counts, ``options`` the (word, log chance of being seen so) of doubtful words,
    ``share`` the part of a doubtful word's occurrences that misreadings don't explain.
    """

    def __init__(self, words: dict[str, int], options: dict[str, list[tuple[str, float]]], share: dict[str, float], pairs: dict[tuple[str, str], int], total: int):
        self.words, self.options, self.share, self.pairs, self.total = words, options, share, pairs, max(total, 1)

    def candidates(self, word: str) -> list[tuple[str, float]]:
        """(word, log chance of being seen as ``word``) of a doubtful word; none if it is trusted."""
        if is_number(word):
            return [(as_number(word), MISREAD_DIGIT)]
        return self.options.get(word, [])

    def _next(self, a: str | None, b: str) -> float:
        known = max(self.words.get(b, 0) * self.share.get(b, 1.0), UNSEEN)
        if a is None:
            return math.log(known / self.total)
        pair = self.pairs.get((a, b), 0) * self.share.get(a, 1.0) * self.share.get(b, 1.0)
        return math.log((pair + 5 * known / self.total) / (self.words.get(a, 0) * self.share.get(a, 1.0) + 5))

    def wanted_pairs(self, words: list[str]) -> set[tuple[str, str]]:
        """Pairs that ``decode`` of a line asks for."""
        out: set[tuple[str, str]] = set()
        options = [[w, *(v for v, _ in self.candidates(w))] for w in words]
        for i in range(1, len(words)):
            if len(options[i - 1]) > 1 or len(options[i]) > 1:
                out.update(itertools.product(options[i - 1], options[i]))
        return out

    def decode(self, words: list[str]) -> list[str]:
        """Likeliest true words of a line.

        A trusted word has one reading, so the line falls into stretches of doubtful words
        between trusted neighbours, each decoded on its own.
        """
        out = list(words)
        k, n = 0, len(words)
        while k < n:
            if not self.candidates(words[k]):
                k += 1
                continue
            first = k
            back: list[list[int]] = []
            options = [(w, e) for w, e in ((words[k], RIGHT), *self.candidates(words[k]))]
            before = words[k - 1] if k else None
            best = [self._next(before, w) + e for w, e in options]
            columns = [options]
            k += 1
            while k < n and (more := self.candidates(words[k])):
                options = [(words[k], RIGHT), *more]
                step = [[s + self._next(u, w) for s, (u, _) in zip(best, columns[-1], strict=True)] for w, _ in options]
                back.append([max(range(len(row)), key=row.__getitem__) for row in step])
                best = [row[j] + e for row, j, (_, e) in zip(step, back[-1], options, strict=True)]
                columns.append(options)
                k += 1
            if k < n:
                best = [s + self._next(u, words[k]) for s, (u, _) in zip(best, columns[-1], strict=True)]
            j = max(range(len(best)), key=best.__getitem__)
            for c in range(len(columns) - 1, -1, -1):
                out[first + c] = columns[c][j][0]
                if c:
                    j = back[c - 1][j]
        return out


class Scan:
    """Finds page matter and the lines that must be decoded; made once per Python worker."""

    def __init__(self, names: list[str], bits: np.ndarray):
        self.pages, self.doubtful = Pages(names), Filter(bits)
        self.trusted: set[str] = set()

    def may_be_doubtful(self, word: str) -> bool:
        return is_number(word) or word in self.doubtful

    def _doubts(self, tokens: list[str]) -> bool:
        """Whether a token may be doubtful; trusted ones are remembered as they stand."""
        if self.trusted.issuperset(tokens):
            return False
        doubt = False
        for t in tokens:
            if t not in self.trusted:
                core = t.strip(_EDGES)
                if core and self.may_be_doubtful(core):
                    doubt = True
                else:
                    if len(self.trusted) > REMEMBER:
                        self.trusted.clear()
                    self.trusted.add(t)
        return doubt

    def scan(self, text: str, own_id: str | None) -> tuple[dict[int, str], list[tuple[list[tuple[int, str]], list[str]]]]:
        """(page matter by line index, units of (index, line) that belong together and the words whose counts they need)."""
        plain = [_real(x) for x in text.split("\n")]
        matter = self.pages.find(plain, own_id)
        live = [i for i, x in enumerate(plain) if i not in matter and x.strip()]
        units: list[tuple[list[tuple[int, str]], list[str]]] = []
        unit: list[int] = []
        wanted: set[str] = set()
        for k, i in enumerate(live):
            unit.append(i)
            following = plain[live[k + 1]] if k + 1 < len(live) else None
            broken = _parts(plain[i], following) if following is not None and plain[i].rstrip()[-1] in _BREAK else None
            tokens = plain[i].split(" ")
            if broken:
                wanted.update((broken[0], broken[1], broken[0] + broken[1], broken[0] + "-" + broken[1]))
            if self._doubts(tokens) or broken or len(unit) > 1:
                pairs = [(t, c) for t in tokens if (c := t.strip(_EDGES))]
                cores = [c for _, c in pairs]
                doubts = [t not in self.trusted and self.may_be_doubtful(c) for t, c in pairs]
                for j, c in enumerate(cores):
                    # a broken word's neighbours on both lines count as well
                    if doubts[j] or broken and j >= len(cores) - 2 or len(unit) > 1 and j < 2 or j and doubts[j - 1] or j + 1 < len(cores) and doubts[j + 1]:
                        wanted.add(c)
                        if is_number(c):
                            wanted.add(as_number(c))
            if not broken:
                if wanted:
                    units.append(([(j, plain[j]) for j in unit], sorted(wanted)))
                unit, wanted = [], set()
        if unit and wanted:
            units.append(([(j, plain[j]) for j in unit], sorted(wanted)))
        return matter, units


def joined_lines(lines: list[tuple[int, str]], channel: Channel) -> tuple[dict[int, set[str]], dict[int, str]]:
    """(noise, text) by line index of a unit's lines once its broken words are joined."""
    known = channel.words
    noise: dict[int, set[str]] = {}
    fixed = dict(lines)
    moved: dict[int, int] = {}  # characters of the line that now stand on the line before
    for (i, text), (nxt, following) in zip(lines, lines[1:], strict=False):
        parts = _parts(text, following)
        if parts is None:
            continue
        left, right, head, tail = parts
        line = text.rstrip()
        joined, kept = left + right, left + "-" + right
        true, true_kept = channel.candidates(joined), channel.candidates(kept)
        count = lambda word, options: known.get(word, 0) or (known.get(options[0][0], 0) if options else 0)
        as_one, as_two = count(joined, true), count(kept, true_kept)
        if line[-1] == "-" and (as_two > as_one or (not as_one and not as_two and known.get(left, 0) >= RARE and known.get(right, 0) >= RARE)):
            whole, broken = kept, False
        elif as_two > 10 * as_one:
            whole, broken = kept, False
        else:
            whole, broken = joined, True
        if broken:
            noise.setdefault(i, set()).add("broken_word")
        best = true if broken else true_kept
        truth = best[0][0] if best else whole
        if truth != whole:
            # the first difference tells on which line the misread character stands
            at = next((p for p, (x, y) in enumerate(zip(whole, truth, strict=False)) if x != y), min(len(whole), len(truth)))
            noise.setdefault(i if at < len(left) else nxt, set()).add("misread")
        fixed[i] = line[: len(line) - len(tail.lstrip(_EDGES))] + truth + head.group(1)[len(right) + head.group(1).find(right) :]
        moved[nxt] = head.end()
    for i, start in moved.items():
        # a line may have given its first word away and still end in a broken one
        original = dict(lines)[i]
        fixed[i] = fixed[i][start:].lstrip() if fixed[i].startswith(original[:start]) else fixed[i]
    return noise, fixed


def decoded_lines(lines: list[tuple[int, str]], channel: Channel) -> tuple[dict[int, set[str]], dict[int, str]]:
    """(noise, repaired text) by line index of a unit's lines."""
    noise, fixed = joined_lines(lines, channel)
    for i, now in fixed.items():
        tokens = now.split(" ")
        cores = [t.strip(_EDGES) for t in tokens]
        words = [c for c in cores if c]
        if not any(map(channel.candidates, words)):
            continue
        decoded = iter(channel.decode(words))
        out = []
        for t, c in zip(tokens, cores, strict=True):
            if c:
                d = next(decoded)
                if d != c:
                    noise.setdefault(i, set()).add("misread")
                    t = t.replace(c, d, 1)
            out.append(t)
        fixed[i] = " ".join(out)
    return noise, fixed


def paragraphs(lines: list[str | None]) -> str:
    """Lines without page matter as running paragraphs; headings and labelled lines stay alone."""
    out: list[str] = []
    open_line = False
    for line in lines:
        if line is None:
            continue
        s = line.strip()
        if not s:
            open_line = False
            if out and out[-1]:
                out.append("")
            continue
        alone = s == s.upper() and any(c.isalpha() for c in s) or re.match(r"[^\W\d_][\w ()/-]{2,30} ?: \S", s) or s.endswith(":")
        if open_line and not alone:
            out[-1] += " " + s
        else:
            out.append(s)
        open_line = not alone
    return "\n".join(out).strip("\n")



def _channel(facts: str | None, pairs: str | None, total: int) -> Channel:
    """Channel over what was joined to a unit: a line a word, "word count share option count chance option ...", and a line a pair."""
    words: dict[str, int] = {}
    options: dict[str, list[tuple[str, float]]] = {}
    share: dict[str, float] = {}
    for line in facts.split("\n") if facts else ():
        w, n, part, *found = line.split(" ")
        words[w] = int(n)
        if found:
            options[w] = [(found[i], float(found[i + 2])) for i in range(0, len(found), 3)]
            share[w] = float(part)
            for i in range(0, len(found), 3):
                words.setdefault(found[i], int(found[i + 1]))
    return Channel(words, options, share, {(a, b): int(n) for a, b, n in (x.split(" ") for x in pairs.split("\n"))} if pairs else {}, total)


def _lines(value: str) -> list[tuple[int, str]]:
    return [(int(no), x) for no, _, x in (part.partition("\t") for part in value.split("\n"))]


def _decoded(df: DataFrame, names: DataFrame, key: str, own_id: str, text: str, name: str) -> DataFrame:
    """(key, no, noise, text): every line of page matter (text is null) and every decoded line with its noise and repaired text."""
    spark = df.sparkSession
    listed = [r[0] for r in collect_bounded(names.select(name), MAX_NAMES, "the table of names")]
    corpus = Corpus(df, text)
    total = corpus.total
    shared = spark.sparkContext.broadcast((listed, corpus.filter()))
    body = spread(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{own_id}`").alias("own"), F.col(f"`{text}`").alias("text"))).where("text is not null")
    kind = dict(body.dtypes)["key"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = once(shared, lambda v: Scan(*v))
        for batch in batches:
            rows = []
            for k, own, value in zip(batch["key"], batch["own"], batch["text"], strict=True):
                matter, units = scanner.scan(value, own)
                rows += [(k, i, what, None, None) for i, what in sorted(matter.items())]
                rows += [(k, lines[0][0], None, "\n".join(f"{i}\t{x}" for i, x in lines), " ".join(wanted)) for lines, wanted in units]
            yield pd.DataFrame(rows, columns=["key", "no", "noise", "lines", "wanted"])

    scanned = cut(body.mapInPandas(scan, f"key {kind}, no int, noise string, lines string, wanted string"))
    units = scanned.where("lines is not null").select("key", "no", "lines")
    asked = scanned.where("lines is not null").select("key", "no", F.explode(F.split("wanted", " ")).alias("w"))
    known = corpus.words.join(corpus.doubtful, "w", "left")
    # words hold no white space, so what is known of them travels as plain text
    option = F.transform("options", lambda x: F.concat_ws(" ", x["v"], x["n"], x["p"]))
    fact = F.concat_ws(" ", "w", "n", F.coalesce("share", F.lit(1.0)), F.array_join(option, " "))
    facts = asked.join(known.select("w", fact.alias("fact")), "w").groupBy("key", "no").agg(F.array_join(F.collect_list("fact"), "\n").alias("facts"))
    with_facts = units.join(facts, ["key", "no"])

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, no, lines, found in zip(batch["key"], batch["no"], batch["lines"], batch["facts"], strict=True):
                channel = _channel(found, None, total)
                pairs: set[tuple[str, str]] = set()
                for x in joined_lines(_lines(lines), channel)[1].values():
                    pairs |= channel.wanted_pairs([c for t in x.split(" ") if (c := t.strip(_EDGES))])
                rows += [(k, no, a, b) for a, b in sorted(pairs)]
            yield pd.DataFrame(rows, columns=["key", "no", "a", "b"])

    needed = with_facts.mapInPandas(wanted, f"key {kind}, no int, a string, b string")
    pairs = needed.join(corpus.pairs, ["a", "b"]).groupBy("key", "no").agg(F.array_join(F.collect_list(F.concat_ws(" ", "a", "b", "n")), "\n").alias("pairs"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, lines, found, with_pairs in zip(batch["key"], batch["lines"], batch["facts"], batch["pairs"], strict=True):
                before = _lines(lines)
                noise, fixed = decoded_lines(before, _channel(found, with_pairs, total))
                for i, x in before:
                    kinds = sorted(noise.get(i, ())) or ([None] if fixed[i] != x else [])
                    rows += [(k, i, what, fixed[i]) for what in kinds]
            yield pd.DataFrame(rows, columns=["key", "no", "noise", "text"])

    done = with_facts.join(pairs, ["key", "no"], "left").select("key", "lines", "facts", "pairs").mapInPandas(decode, f"key {kind}, no int, noise string, text string")
    return scanned.where("lines is null").select("key", "no", "noise", F.lit(None).cast("string").alias("text")).unionByName(done)


def find_noise(df: DataFrame, names: DataFrame, key: str = "record_id", own_id: str = "report_id", text: str = "text", name: str = "lab_name") -> DataFrame:
    """(key, line_no, noise) of every noisy line; a line can be broken_word and misread."""
    found = _decoded(df, names, key, own_id, text, name).where("noise is not null")
    return found.select(F.col("key").alias(key), (F.col("no") + 1).alias("line_no"), "noise")


def repair(df: DataFrame, names: DataFrame, key: str = "record_id", own_id: str = "report_id", text: str = "text", name: str = "lab_name") -> DataFrame:
    """(key, text) with page matter removed, words whole, misread words repaired; clean texts unchanged."""
    fixes = _decoded(df, names, key, own_id, text, name).groupBy("key").agg(F.collect_set(F.struct("no", "text")).alias("fixes"), F.bool_or(F.col("noise").isNotNull()).alias("noisy"))
    body = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(fixes, "key", "left")

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value, found, noisy in zip(batch["text"], batch["fixes"], batch["noisy"], strict=True):
                if isinstance(value, str) and noisy is not None and noisy == True:  # noqa: E712
                    lines: list[str | None] = [_real(x) for x in value.split("\n")]
                    for f in found:
                        lines[f["no"]] = f["text"]
                    value = paragraphs(lines)
                out.append(value)
            yield pd.DataFrame({"key": batch["key"], "text": out})

    return body.mapInPandas(mend, f"key {dict(body.dtypes)['key']}, text string").withColumnRenamed("key", key)
