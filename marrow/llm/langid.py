"""Language of documents and of each passage, whatever their labels say.

Letters have random bipolar hypervectors; an n-gram is the product of its letters' vectors,
each rotated by its place, and a text is the bundle (sum) of its n-grams. A language's
prototype is the bundle of its n-grams, each weighted by the square root of its share less
the mean over all languages (over the root of that mean, ``SHARPEN``). A passage is compared with the prototypes by cosine:
the dot product is linear in the n-grams, so each distinct n-gram is compared once, in
batches, and kept as a row of scores; the passage's norm is taken from its n-gram counts, as
different n-grams' vectors are orthogonal up to 1 / sqrt(``DIMENSIONS``). The words of a post
are decoded by Viterbi with a cost for switching language, lower at the end of a sentence or
line, so mixed posts come out as segments. A segment whose cosine is below what passages of
its length in the known languages reach is in another language, ``OTHER``. Confidence is the
softmax of the cosines, with a temperature fitted on the sample.

Prototypes are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); passages that
contradict their label are left out and the prototypes bundled anew. Languages are those
whose labels occur in the sample.

Quote headers, signatures, markers, links, code and numbers are taken out before; of a line
that mixes code and prose only the code goes. "@" written for "a" is a letter. A signature is
what stands below a "--" line or another rule at the end of a post or quote: at most
``SIGNATURE_LINES`` short lines; under rules other than "--" they must not end like sentences.
Text below any other rule is prose. A language is present if one of its segments has
``MIN_WORDS`` words.

Defined cases: null, empty and blank texts and texts without such a segment have no rows;
labels are compared after unifying case, region, three-letter codes and English names;
null, blank and other codes that name none of the known languages count as missing;
repeated rows are reported each for itself; whole texts are read.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marrow.session import once, spread

#: Common forms of each code, lower case, without region.
ALIASES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "castilian", "español", "espanol"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "it": ("it", "ita", "italian", "italiano"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands", "flemish"),
}
#: Name of a passage in none of the languages of the prototypes.
OTHER = "und"
#: Size of hypervectors and longest n-gram.
DIMENSIONS, LONGEST = 8192, 4
#: Power of an n-gram's mean weight by which its weights are divided: 0 leaves common n-grams their weight, 1 takes all of it.
SHARPEN = 0.5
#: Labelled rows the prototypes are bundled from, at most, and passages of them.
SAMPLE_ROWS, SAMPLE_PASSAGES = 4000, 60_000
#: Passages of the sample from which temperature and least cosines are taken, about.
CALIBRATED = 10_000
#: Share of the sample's passages that may fall below the least cosine of their length, and what is taken off it.
FLOOR_SHARE, FLOOR_SLACK = 0.002, 0.8
#: Lengths in words from which a least cosine of its own holds.
FLOOR_FROM = (1, 5, 7, 10, 14, 20)
#: n-grams whose vectors are made at a time.
CHUNK = 2048
MIN_WORDS = 5
#: Segments less sure than this don't count as present beside a surer one; if a post has none, its surest counts.
MIN_CONFIDENCE = 0.9
#: Distinct words and n-grams a Python worker keeps; both are emptied when full, which only costs time.
REMEMBER = 300_000
#: Cost of a switch inside a sentence and at its end, in mean word margins.
SWITCH_INSIDE, SWITCH_END = 9.0, 2.5
#: Lines of a signature and characters of each, at most.
SIGNATURE_LINES, SIGNATURE_WIDTH = 4, 80

_TAG = re.compile(r"<[/!?]?[a-zA-Z|][^<>\n]{0,400}>|\[/?[a-zA-Z*][^\[\]\n]{0,120}\]|<\|[a-z_]+\|>")
_LINK = re.compile(r"(?:https?://|www\.|ftp://)\S+|\S+@\S+\.\w+|\b(?=\S{0,200}[\d_/\\=&%+#])\S{31,}|[\w-]+(?:/[\w.-]+){2,}|\b\w+\.(?:png|jpe?g|gif|pdf|txt|csv|svs|html?)\b")
_FILE = re.compile(r"\.(?:png|jpe?g|gif|pdf|txt|csv|svs|html?)\b")
_HEADER = re.compile(r"^[\s>|]*(?:[^\n]{0,80}\s)?(?:wrote|schrieb|escribió|escribio|a écrit|a ecrit|escreveu|ha scritto|schreef|said|sagte)(?: \w+)?\s*:\s*$", re.I)
_RULE = re.compile(r"[\s>|]*(?:--+|__+|==+|\*\*\*+|~~+|—+)\s*$")
_CODE = re.compile(r"[{}\[\]=;<>_|\\+*^$#@~/]")
#: "@" written for "a": in or at a word, or alone before a word.
_AT = re.compile(r"(?<=[^\W\d_])@+|@+(?=[^\W\d_])|(?<!\S)@(?=[ \t]+[^\W\d_])")
_LETTER = r"(?:[^\W\d_]|(?<=[^\W\d_])@|@(?=@*[^\W\d_])|(?<=[^\W\d_]@)@|(?<!\S)@(?=[ \t]+[^\W\d_]))"
_AT_WORD = re.compile(rf"{_LETTER}+(?:['’]{_LETTER}+)*")
#: A word and what stands between it and the next one.
_WORD_GAP = re.compile(r"([^\W\d_]+(?:['’][^\W\d_]+)*)([\W\d_]*)")
#: A word with nothing but punctuation, brackets or emphasis around it.
_PLAIN = re.compile(rf"[(\[{{<\"'“”„‘’«»‹›¿¡*_~|>-]*{_LETTER}+(?:['’/-]{_LETTER}+)*[)\]}}>\"'“”„‘’«»‹›.,:;!?…*_~|-]*")
#: Structures whose inside is code too.
_STRUCTURE = re.compile(r"\{[^{}]*[:=;][^{}]*\}|\w+\([^()]*[=\[\]{};_][^()]*\)|\[[^\[\]]*[=:;][^\[\]]*\]")
#: Words of common programming languages, no prose by themselves.
KEYWORDS = frozenset(
    "if else elif return def for in while import from print select where and or not class var let const function int float "
    "double char bool boolean string str void null none nil true false new try except catch finally raise throw lambda with as "
    "is end then do echo public private static final order group by insert into update set delete values join on".split()
)
#: A line that ends or begins like a statement.
_STATEMENT = re.compile(r"[;{]\s*$|^\s*(?:\w+\s+){0,2}[\w.]+\s*[-+*/|&]?=(?!=)")
#: Words that are no keywords, from which on a line with signs of code is prose too; ``MIN_WORDS`` in a statement.
LEAST_PROSE = 3
_END = re.compile(r"[.!?;:…。\n]|\s{2,}")
_SENTENCE_END = (".", "!", "?", "…", ":", ";", ",")

_BY_ALIAS = {a: code for code, names in ALIASES.items() for a in names}


def language_of_label(label: str | None) -> str | None:
    if not isinstance(label, str):
        return None
    whole = label.strip().lower()
    return _BY_ALIAS.get(whole) or _BY_ALIAS.get(re.split(r"[-_.@ ]", whole, maxsplit=1)[0])


def without_code(line: str) -> str:
    """A line with its code blanked out in place; nothing is left of a line that is all code."""

    def blank(m: re.Match[str]) -> str:
        return " " * len(m.group())

    left = _STRUCTURE.sub(blank, line)
    left = re.sub(r"\S+", lambda m: blank(m) if _CODE.search(_AT.sub("a", m.group())) and not _PLAIN.fullmatch(m.group()) else m.group(), left)
    plain = [w.strip("()[]{}<>\"'“”„‘’«»‹›.,:;!?…*_~|-").lower() for w in left.split() if _PLAIN.fullmatch(w)]
    own = sum(w not in KEYWORDS for w in plain)
    return left if own >= (MIN_WORDS if _STATEMENT.search(line) else LEAST_PROSE) and own > len(plain) - own else ""


def _level(line: str) -> int:
    """Depth of quotation by the marks a line begins with."""
    depth = 0
    for c in line:
        if c == ">":
            depth += 1
        elif c not in "| \t":
            break
    return depth


def signature_lines(lines: list[str]) -> set[int]:
    """Indices of the lines of signatures, their rules included."""
    out: set[int] = set()
    for k, line in enumerate(lines):
        rule = line.lstrip(" >|\t")[:1]
        if not rule or rule not in "-_=*~—" or not _RULE.match(line):
            continue
        level, block = _level(line), []
        for i in range(k + 1, len(lines)):
            if lines[i].strip(" >|\t") and _level(lines[i]) != level:
                break
            block.append(i)
        shown = [lines[i].strip(" >|\t") for i in block if lines[i].strip(" >|\t")]
        if not shown or len(shown) > SIGNATURE_LINES or max(map(len, shown)) > SIGNATURE_WIDTH:
            continue
        if line.strip(" >|\t") == "--" or not any(s.endswith(_SENTENCE_END) for s in shown):
            out.update((k, *block))
    return out


class _Ends(dict[str, bool]):
    """Whether what stands between two words ends a sentence; remembered, as most gaps recur."""

    def __missing__(self, gap: str) -> bool:
        if len(self) > 50_000:
            self.clear()
        found = self[gap] = _END.search(gap) is not None
        return found


_ends = _Ends()


def prose(text: str) -> list[tuple[list[str], list[bool]]]:
    """Words of the natural-language lines, and whether each ends a sentence, paragraph by paragraph."""
    if "&" in text:
        text = html.unescape(text)
    text = text.replace("\xa0", " ").replace("\r\n", "\n").replace("\r", "\n")
    paragraphs: list[tuple[list[str], list[bool]]] = [([], [])]
    lines = text.split("\n")
    signed = signature_lines(lines) if "--" in text or "__" in text or "==" in text or "**" in text or "~~" in text or "—" in text else ()
    depth = None
    for no, line in enumerate(lines):
        if no in signed:
            paragraphs.append(([], []))
            continue
        plain = line
        if "<" in line or "[" in line:
            plain = _TAG.sub(lambda m: " \n " if m.group()[:2] in ("<p", "</", "<b", "<d") and len(m.group()) > 3 else " ", line)
        if "/" in plain or "@" in plain or "www." in plain or _FILE.search(plain) or len(plain) > 30 and max(map(len, plain.split()), default=0) > 30:
            plain = _LINK.sub(" ", plain)
        body = plain.strip(" >|\t*_~​")
        if not body or (line.endswith(":") or line.rstrip().endswith(":")) and _HEADER.match(plain):
            paragraphs.append(([], []))
            continue
        if _CODE.search(body):
            signs = len(_CODE.findall(_AT.sub("a", body).replace("**", "").replace("_", "").replace("*", "")))
            if signs >= 2 and signs > 0.04 * len(body):
                plain = without_code(plain)
                if not plain:
                    paragraphs.append(([], []))
                    continue
        level = _level(line)
        if level != depth and depth is not None:
            paragraphs.append(([], []))
        depth = level
        if "@" in plain:
            found = list(_AT_WORD.finditer(plain))
            pairs = [(m.group(), plain[m.end() : found[k + 1].start() if k + 1 < len(found) else len(plain)]) for k, m in enumerate(found)]
        else:
            pairs = _WORD_GAP.findall(plain)
        if pairs:
            words, ended = paragraphs[-1]
            words += [w for w, _ in pairs]
            ended += [_ends[gap] for _, gap in pairs[:-1]]
            ended.append(_ends[pairs[-1][1].strip()])
    return [p for p in paragraphs if p[0]]


def fold(word: str) -> str:
    return unicodedata.normalize("NFC", word).lower().replace("’", "'").replace("@", "a")


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, index of the word) of every n-gram of 1 to ``LONGEST`` letters of words with their borders.

    A letter is a UTF-16 unit, so a code holds up to four of them in 64 bits.
    """
    units = np.frombuffer("".join(f" {w} " for w in words).encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w.encode("utf-16-le", "surrogatepass")) // 2 + 2 for w in words])
    codes, owners = [], []
    code = np.zeros(len(units), np.uint64)
    for n in range(1, LONGEST + 1):
        last = len(units) - n + 1
        if last <= 0:
            break
        code = code[:last] | units[n - 1 :] << np.uint64(16 * (n - 1))
        inside = owner[:last] == owner[n - 1 :]
        if n == 1:
            inside = inside & (units != 32)
        codes.append(code[inside])
        owners.append(owner[:last][inside])
    return np.concatenate(codes), np.concatenate(owners)


class Space:
    """Hypervectors of letters and n-grams, made from the letters alone."""

    def __init__(self) -> None:
        self.rolled: dict[tuple[int, int], np.ndarray] = {}

    def letter(self, unit: int, places: int) -> np.ndarray:
        v = self.rolled.get((unit, places))
        if v is None:
            if len(self.rolled) > 20_000:
                self.rolled.clear()
            v = self.rolled[unit, places] = np.roll(np.random.default_rng([7, unit]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1, places)
        return v

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row per n-gram: its letters' vectors, each rotated by its place, multiplied."""
        out = np.ones((len(codes), DIMENSIONS), np.int8)
        for k in range(LONGEST):
            units = (codes >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64)
            seen, where = np.unique(units, return_inverse=True)
            table = np.stack([self.letter(u, k) if u else np.ones(DIMENSIONS, np.int8) for u in seen.tolist()])
            out *= table[where]
        return out


class Prototypes:
    """Unit prototype of each language, mean margin of a word, temperature and least cosines by length."""

    def __init__(self, languages: tuple[str, ...], vectors: np.ndarray):
        self.languages, self.vectors = languages, vectors
        self.margin, self.temperature = 1.0, 0.05
        self.floors = (-1.0,) * len(FLOOR_FROM)
        #: n-grams of the sample and their products with the prototypes, so that workers need not compute them again
        self.codes, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32)

    @classmethod
    def fit(cls, passages: list[tuple[list[str], str]], rounds: int = 3) -> Prototypes:
        """From (words, language) passages; labels may be wrong here and there."""
        languages = tuple(sorted({c for _, c in passages}))
        if len(languages) < 2:
            return cls(languages, np.zeros((len(languages), DIMENSIONS), np.float32))
        label = np.array([languages.index(c) for _, c in passages])
        vocabulary = sorted({w for words, _ in passages for w in words})
        code, owner = ngrams(vocabulary)
        known, gram = np.unique(code, return_inverse=True)
        place = {w: i for i, w in enumerate(vocabulary)}
        word = np.fromiter((place[w] for words, _ in passages for w in words), np.int64)
        length = np.array([len(words) for words, _ in passages])
        passage = np.repeat(np.arange(len(passages)), length)
        trusted = np.ones(len(passages), bool)
        for _ in range(rounds):
            counts = np.zeros((len(languages), len(known)))
            for k in range(len(languages)):
                each = np.bincount(word[(trusted & (label == k))[passage]], minlength=len(vocabulary))
                counts[k] = np.bincount(gram, each[owner], len(known))
            share = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
            weight = ((share - share.mean(0)) / np.maximum(share.mean(0), 1e-9) ** SHARPEN).astype(np.float32)
            weight /= np.linalg.norm(weight, axis=1, keepdims=True) + 1e-9
            # what the products with the bundles are but for the noise of the space
            total = cls._sums(weight.T, owner, gram, word, passage, len(vocabulary), len(passages))
            agrees = total.argmax(1) == label
            if (agrees == trusted).all():
                break
            trusted = agrees
        vectors, space = np.zeros((len(languages), DIMENSIONS), np.float32), Space()
        for at in range(0, len(known), CHUNK):
            vectors += weight[:, at : at + CHUNK] @ space.vectors(known[at : at + CHUNK]).astype(np.float32)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
        scores = np.concatenate([space.vectors(known[at : at + CHUNK]).astype(np.float32) @ vectors.T for at in range(0, len(known), CHUNK)])
        total = cls._sums(scores, owner, gram, word, passage, len(vocabulary), len(passages))
        made = cls(languages, vectors)
        made.codes, made.scores = known, scores
        right = total[np.arange(len(passages)), label]
        others = np.where(np.arange(len(languages)) == label[:, None], -np.inf, total).max(1)
        sure = trusted & (length >= 4)
        if sure.any():
            made.margin = float(np.median(((right - others) / length)[sure]))
            judge = Judge(made)
            judge.learn(vocabulary)
            # an even part of them is enough to calibrate on
            some = np.flatnonzero(sure)[:: max(1, int(sure.sum()) // CALIBRATED)]
            held = [(passages[i][0], label[i]) for i in some.tolist()]
            whole = np.stack([judge.cosine([judge.rows[w] for w in words]) for words, _ in held])
            short = np.stack([judge.cosine([judge.rows[w] for w in words[:MIN_WORDS]]) for words, _ in held])
            made._calibrate(whole, short, label[some], length[some])
        return made

    @staticmethod
    def _sums(scores: np.ndarray, owner: np.ndarray, gram: np.ndarray, word: np.ndarray, passage: np.ndarray, n_words: int, n_passages: int) -> np.ndarray:
        """Scores of n-grams added up to words and those to passages."""
        by_word = [np.bincount(owner, scores[gram, k], n_words) for k in range(scores.shape[1])]
        return np.stack([np.bincount(passage, w[word], n_passages) for w in by_word], 1)

    def _calibrate(self, cosines: np.ndarray, short: np.ndarray, label: np.ndarray, length: np.ndarray) -> None:
        """Temperature by likelihood over the shortest passages that count, least cosines by length."""
        own, first = (c[np.arange(len(label)), label] for c in (cosines, short))
        best, least = None, np.inf
        for t in np.geomspace(0.002, 0.2, 30):
            loss = float(np.mean(np.log(np.exp(np.minimum((short - first[:, None]) / t, 500)).sum(1))))
            if loss < least:
                best, least = float(t), loss
        self.temperature = best or self.temperature
        floors = []
        for a, b in zip(FLOOR_FROM, (*FLOOR_FROM[1:], np.inf), strict=True):
            part = own[(length >= a) & (length < b)]
            floors.append(float(np.quantile(part, FLOOR_SHARE)) * FLOOR_SLACK if len(part) >= 50 else floors[-1] if floors else -1.0)
        self.floors = tuple(floors)


class Judge:
    """Scores words and decodes texts against prototypes; made once per Python worker."""

    def __init__(self, prototypes: Prototypes):
        self.model = prototypes
        self.space = Space()
        self._clear()

    def _clear(self) -> None:
        n = len(self.model.languages)
        self.rows: dict[str, int] = {}
        self.codes, self.scores = self.model.codes, self.model.scores
        self.ids = np.arange(len(self.codes), dtype=np.int32)  # of each code, by arrival
        self.table = np.zeros((1024, n), np.float32)
        self.grams: list[np.ndarray] = []

    def learn(self, words: list[str]) -> None:
        """Score distinct words, all at once; each n-gram is compared with the prototypes once."""
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) > REMEMBER or len(self.codes) > 4 * REMEMBER:
            self._clear()
            new = list(dict.fromkeys(words))
        if not new:
            return
        code, owner = ngrams([fold(w) for w in new])
        distinct, gram = np.unique(code, return_inverse=True)
        at = np.searchsorted(self.codes, distinct)
        fresh = np.ones(len(distinct), bool)
        if len(self.codes):
            fresh = self.codes[np.minimum(at, len(self.codes) - 1)] != distinct
        scores = np.empty((len(distinct), len(self.model.languages)), np.float32)
        ids = np.empty(len(distinct), np.int32)
        if not fresh.all():
            scores[~fresh], ids[~fresh] = self.scores[at[~fresh]], self.ids[at[~fresh]]
        todo = np.flatnonzero(fresh)
        for k in range(0, len(todo), CHUNK):
            scores[todo[k : k + CHUNK]] = self.space.vectors(distinct[todo[k : k + CHUNK]]).astype(np.float32) @ self.model.vectors.T
        if len(todo):
            ids[todo] = np.arange(len(self.codes), len(self.codes) + len(todo))
            order = np.argsort(codes := np.concatenate([self.codes, distinct[todo]]), kind="stable")
            self.codes, self.scores, self.ids = codes[order], np.concatenate([self.scores, scores[todo]])[order], np.concatenate([self.ids, ids[todo]])[order]
        first = len(self.grams)
        while len(self.table) < first + len(new):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for k in range(len(self.model.languages)):
            self.table[first : first + len(new), k] = np.bincount(owner, scores[gram, k], len(new))
        by_word = np.argsort(owner, kind="stable")
        self.grams += np.split(ids[gram[by_word]], np.cumsum(np.bincount(owner, minlength=len(new)))[:-1])
        self.rows |= {w: first + i for i, w in enumerate(new)}

    def row(self, word: str) -> int:
        if word not in self.rows:
            self.learn([word])
        return self.rows[word]

    def cosine(self, rows: list[int]) -> np.ndarray:
        """Cosine of the bundle of a passage's words with each prototype."""
        return self._cosine(self.table[rows].sum(0), rows)

    def _cosine(self, dot: np.ndarray, rows: list[int]) -> np.ndarray:
        grams = np.concatenate(list(map(self.grams.__getitem__, rows)))
        grams.sort()
        edges = (grams[1:] != grams[:-1]).nonzero()[0]
        if len(edges):
            n = edges[1:] - edges[:-1]
            squares = int(n @ n) + (int(edges[0]) + 1) ** 2 + (len(grams) - 1 - int(edges[-1])) ** 2
        else:
            squares = len(grams) ** 2
        return dot / math.sqrt(DIMENSIONS * squares + 1e-9)

    def segments(self, text: str) -> list[tuple[str, int, float, str]]:
        """(language, words, confidence, passage) of consecutive words in one language."""
        return self.segments_of([text])[0]

    def segments_of(self, texts: list[str], with_passage: bool = True) -> list[list[tuple[str, int, float, str]]]:
        """``segments`` of many texts, whose new words are scored together; passages are empty unless asked for."""
        parsed = [prose(t) for t in texts]
        self.learn([w for paragraphs in parsed for words, _ in paragraphs for w in words])
        return [[s for words, ended in paragraphs for s in self._paragraph(words, ended, with_passage)] for paragraphs in parsed]

    def _paragraph(self, words: list[str], ended: list[bool], with_passage: bool) -> list[tuple[str, int, float, str]]:
        model = self.model
        if not model.languages:
            return []
        rows = list(map(self.rows.__getitem__, words))
        each = self.table[rows]
        found: list[tuple[str, int, int, float]] = []
        for k, a, b in self._runs(each / model.margin, ended):
            cos = self._cosine(each[a:b].sum(0), rows[a:b])
            odds = np.exp((cos - cos.max()) / model.temperature)
            floor = model.floors[sum(b - a >= x for x in FLOOR_FROM) - 1]
            if cos[k] < floor:
                sure = 1 - float(cos[k] / floor) if floor > 0 else 0.0
                if found and found[-1][0] == OTHER:
                    found[-1] = (OTHER, found[-1][1], b, max(found[-1][3], min(sure, 1.0)))
                else:
                    found.append((OTHER, a, b, min(sure, 1.0)))
            else:
                found.append((model.languages[k], a, b, float(odds[k] / odds.sum())))
        return [(lang, b - a, sure, " ".join(words[a:b]) if with_passage else "") for lang, a, b, sure in found]

    @classmethod
    def _runs(cls, each: np.ndarray, ended: list[bool]) -> list[tuple[int, int, int]]:
        """(language, first word, word after the last) of the likeliest languages of the words.

        Each stretch in another language bears half of the costs of the switches at its ends. If no
        stretch gains more than that over one language throughout, that is the best path; else it
        is decoded word by word.
        """
        n = len(each)
        k = int(each.sum(0).argmax())
        cost = np.zeros((n + 1, 1), np.float32)
        cost[1:n, 0] = [SWITCH_END / 2 if e else SWITCH_INSIDE / 2 for e in ended[: n - 1]]
        run = np.zeros((n + 1, each.shape[1]), np.float32)
        (each - each[:, k : k + 1]).cumsum(0, out=run[1:])
        if (run - cost - np.minimum.accumulate(run + cost)).max() <= 0:
            return [(k, 0, n)]
        path = cls._decode(each.tolist(), ended)
        starts = [0, *(i for i in range(1, n) if path[i] != path[i - 1]), n]
        return [(path[a], a, b) for a, b in zip(starts, starts[1:], strict=False)]

    @staticmethod
    def _decode(each: list[list[float]], ended: list[bool]) -> list[int]:
        best, back = each[0], []
        for row, end in zip(each[1:], ended, strict=False):
            top = max(best)
            switch, to = top - (SWITCH_END if end else SWITCH_INSIDE), best.index(top)
            back.append([k if b >= switch else to for k, b in enumerate(best)])
            best = [(b if b >= switch else switch) + e for b, e in zip(best, row, strict=True)]
        path = [best.index(max(best))]
        for b in reversed(back):
            path.append(b[path[-1]])
        return path[::-1]


def fit_prototypes(df: DataFrame, key: str, text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Prototypes:
    """Prototypes from at most ``rows`` labelled rows, those with the lowest digests of their keys.

    The keys are ordered alone; texts are fetched for the chosen ones.
    """
    names = sorted(_BY_ALIAS)
    plain = F.lower(F.trim(F.col(f"`{label}`")))
    labelled = df.where(F.col(f"`{text}`").isNotNull() & (plain.isin(names) | F.regexp_extract(plain, "^([a-z]+)[-_]", 1).isin(names)))
    chosen = labelled.select(F.col(f"`{key}`").alias("k")).orderBy(F.xxhash64("k"), "k").limit(rows)
    sample = labelled.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.col(f"`{label}`").alias("l")).join(F.broadcast(chosen), "k", "left_semi").collect()
    passages: list[tuple[list[str], str]] = []
    for r in sorted(sample, key=lambda r: r["k"]):
        code = language_of_label(r["l"])
        for words, ended in prose(r["t"]) if code else ():
            part: list[str] = []
            for w, end in zip(words, ended, strict=True):
                part.append(fold(w))
                if end or len(part) >= 25:
                    if len(part) >= 4:
                        passages.append((part, code))
                    part = []
            if len(part) >= 4:
                passages.append((part, code))
    if len(passages) > SAMPLE_PASSAGES:
        step = len(passages) / SAMPLE_PASSAGES
        passages = [passages[int(i * step)] for i in range(SAMPLE_PASSAGES)]
    return Prototypes.fit(passages)


def identify(df: DataFrame, key: str, text: str = "text", label: str = "lang", prototypes: Prototypes | None = None) -> DataFrame:
    """(key, label, segment_no, lang, n_words, confidence, passage) of every segment of every text."""

    def rows(model: Judge, k: object, code: str | None, segments: list[tuple[str, int, float, str]]) -> list[tuple]:
        return [(k, code, no, *seg) for no, seg in enumerate(segments, 1)]

    return _judged(df, key, text, label, prototypes, rows, "label string, segment_no int, lang string, n_words int, confidence double, passage string")


def relabelled(df: DataFrame, key: str, text: str = "text", label: str = "lang", prototypes: Prototypes | None = None) -> DataFrame:
    """(key, lang, confidence, n_words) of texts whose label is missing or wrong or which mix languages; ``OTHER`` is no language.

    A text is judged where it lies; nothing is shuffled.
    """

    def rows(model: Judge, k: object, code: str | None, segments: list[tuple[str, int, float, str]]) -> list[tuple]:
        counted = [s for s in segments if s[1] >= MIN_WORDS and s[0] != OTHER]
        parts = [s for s in counted if s[2] >= MIN_CONFIDENCE] or sorted(counted, key=lambda s: -s[2])[:1]
        langs = dict.fromkeys(s[0] for s in parts)
        if not langs or len(langs) == 1 and code in langs:
            return []
        return [(k, lang, max(s[2] for s in parts if s[0] == lang), sum(s[1] for s in parts if s[0] == lang)) for lang in langs]

    return _judged(df, key, text, label, prototypes, rows, "lang string, confidence double, n_words int")


def _judged(df: DataFrame, key: str, text: str, label: str, prototypes: Prototypes | None, rows: Callable[..., list[tuple]], schema: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(prototypes or fit_prototypes(df, key, text, label))
    body = spread(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{text}`").alias("text"))).where("text is not null")
    names = ["key", *(x.split()[0] for x in schema.split(", "))]
    with_passage = "passage" in names

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = once(shared, Judge)
        for batch in batches:
            texts, out = batch["text"].tolist(), []
            for at in range(0, len(texts), 500):
                found = model.segments_of(texts[at : at + 500], with_passage)
                for k, lab, segments in zip(batch["key"][at : at + 500], batch["label"][at : at + 500], found, strict=True):
                    out += rows(model, k, language_of_label(lab), segments)
            yield pd.DataFrame(out, columns=names)

    kind = dict(body.dtypes)["key"]
    return body.mapInPandas(judge, f"key {kind}, {schema}").withColumnRenamed("key", key)
