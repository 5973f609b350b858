"""Mapping freely entered values to the entries of a canonical list.

Each distinct value of the table is mapped once:
1. a multi-pattern automaton over the list's terms and synonyms finds embedded mentions at
   word boundaries; the longest non-overlapping ones win. If they name one entry and nothing
   beside them resembles a word of the list, that entry is the value's;
2. token-set similarity: the value's words are matched one to one with the words of each
   form that an index finds (equal, misspelt, shortened, vowels dropped, initials of several
   words) and the matched weight is compared with the weight of both sides; run-together
   values are compared as one word. The best entry is taken if it is good enough and no
   other entry is as good.
Everything else maps to ``NONE``.

What people write around entries is learnt from the table before that: words beside mentions
of ``LEAST_ENTRIES`` different entries are remarks and carry no weight; a short token that
stands where one and the same word of the list is missing, in values of that many entries,
is an abbreviation of it. Words by which entries differ that are otherwise alike weigh more.
Other wordings and abbreviations can be given as arguments.

The distinct values are aggregated map-side, mapped, and joined back on the value; adaptive
execution splits a value that fills a third of the table. The list is small by its meaning;
its size and that of what is learnt are checked.

Defined cases: null and blank cells and cells that are letter for letter a form are not
reported; stand-ins for "not known" map to ``NONE``; a form that two entries share maps
to the entry first by id; an empty list maps everything to ``NONE``; repeated rows are
reported each for itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marrow.operators.bounded import collect_bounded
from marrow.operators.profile import STAND_INS
from marrow.session import cut, once, spread

MAX_TERMS, MAX_LEARNT = 1_000_000, 1_000_000
NONE = "none"
#: Tokens whose resemblances a Python worker remembers.
REMEMBER = 200_000
#: Least similarity of a mapping, and least lead over the next entry.
ACCEPT, LEAD = 0.72, 0.015
#: Similarity from which a value is not compared as one word, too.
SURE = 0.95
#: Entries beside which a word must stand to be a remark, or an abbreviation to be one.
LEAST_ENTRIES = 3
#: Share of a token's places that must speak for one word to make it an abbreviation of it.
LEAST_SHARE = 0.7
#: Words of little weight.
LIGHT = frozenset("of and or to the in with type".split())
#: Weight of a light word, and of a word by which two entries differ.
LIGHT_WEIGHT, TELLING_WEIGHT = 0.25, 1.4
#: Fields whose entries are numbered steps.
ORDINAL = ("tumor_grade",)
_NUMBERS = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "one": "1", "two": "2", "three": "3", "four": "4", "first": "1", "second": "2", "third": "3"}
_SPLIT = re.compile(r"[^\w]+|_")


@lru_cache(maxsize=500_000)
def edits(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance, or ``most`` + 1 if larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    start, last = 0, min(len(a), len(b))
    while start < last and a[start] == b[start]:
        start += 1
    end = 0
    while end < last - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    far = most + 1
    before, row = [], [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        above, row, older = row, [far] * (len(b) + 1), before
        if i <= most:
            row[0] = i
        least = row[0]
        # cells further than ``most`` from the diagonal cost more than ``most``
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            cost = above[j - 1] if x == y else above[j - 1] + 1
            if above[j] < cost:
                cost = above[j] + 1
            if row[j - 1] < cost:
                cost = row[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and older[j - 2] < cost:
                cost = older[j - 2] + 1
            row[j] = cost
            if cost < least:
                least = cost
        if least > most:
            return far
        before = above
    return min(row[-1], far)


def _inside(short: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in short)


@lru_cache(maxsize=500_000)
def likeness(token: str, word: str) -> float:
    """How well a written token stands for ``word``, 0 to 1."""
    if token == word:
        return 1.0
    n = len(word)
    if token.isdigit() or word.isdigit() or n < 3 or len(token) < 2:
        return 0.0
    same_start = token[0] == word[0]
    if n >= 4:
        most = 1 if n <= 5 else 2 if n <= 8 else 3 if n <= 10 else 4
        d = edits(token, word, most)
        if d <= most and (same_start or d <= 1 or (d <= 2 and token[:2] == word[1::-1])):
            return 1 - 0.75 * d / n
    if same_start and len(token) < n:
        if word.startswith(token):
            return 0.9
        vowelless = not any(c in "aeiou" for c in token[1:])
        if vowelless and _inside(token, word):
            return 0.85
        if len(token) >= 3 and edits(token, word[: len(token)], 1) <= 1:
            return 0.72
        if len(token) >= 4 and (edits(token, word[: len(token) - 1], 1) <= 1 or edits(token, word[: len(token) + 1], 1) <= 1):
            return 0.7
    return 0.0


def words(value: str, ordinal: bool = False) -> list[str]:
    text = unicodedata.normalize("NFKC", value)
    text = re.sub(r"(?<=[a-z]{3})(?=[A-Z])", " ", text).lower()
    if ordinal:
        text = re.sub(r"\bof\s*\d\b", " ", text)
    tokens = [t for t in _SPLIT.split(text) if t]
    return ordinal_words(tokens) if ordinal else tokens


def ordinal_words(tokens: list[str]) -> list[str]:
    """Numbered steps in one writing: 'Gr. II/III', 'G2 to G3', 'between grade 2 and 3' become 'grade 2 3'."""
    tokens = [t for raw in tokens for t in re.split(r"(?<=[^\W\d])(?=\d)", raw)]
    tokens = [x for t in tokens for x in (("g", "x") if t == "gx" else (_NUMBERS.get(t, t),))]
    steps = list(dict.fromkeys(t for t in tokens if t in ("1", "2", "3", "4", "x")))
    graded = any(t in ("g", "gr", "nhg") or likeness(t, "grade") >= 0.7 for t in tokens)
    if graded and steps:
        others = [t for t in tokens if not t.isdigit() and t != "x" and t not in ("g", "gr", "nhg", "to", "and", "between", "of") and likeness(t, "grade") < 0.7 and t not in ("hist", "histologic", "histological", "nottingham")]
        pair = steps[:2] if len(steps) > 1 and "x" not in steps[:2] and int(steps[1]) == int(steps[0]) + 1 else steps[:1]
        return ["grade", *pair, *others]
    return tokens


def _bigrams(token: str) -> set[str]:
    marked = "^" + token
    return {marked[i : i + 2] for i in range(len(token))}


class Forms:
    """The forms of one field's entries, indexed by words, bigrams, prefixes and initials."""

    def __init__(self, forms: list[tuple[str, str]], ordinal: bool):
        import ahocorasick

        self.ordinal = ordinal
        self.terms: dict[tuple[str, ...], str] = {}
        for term, form in sorted(forms):
            key = tuple(words(form, ordinal))
            if key:
                self.terms.setdefault(key, term)
        self.keys = list(self.terms)
        self.automaton = ahocorasick.Automaton()
        for key, term in self.terms.items():
            self.automaton.add_word(f" {' '.join(key)} ", (len(key), term))
        if self.keys:
            self.automaton.make_automaton()
        self.holding: dict[str, set[int]] = defaultdict(set)  # word to the forms that hold it
        for i, key in enumerate(self.keys):
            for w in key:
                self.holding[w].add(i)
        self.telling = self._telling()
        self.by_bigram, self.by_start, self.by_prefix = defaultdict(list), defaultdict(list), defaultdict(list)
        for w in self.holding:
            self.by_start[w[0]].append(w)
            for g in _bigrams(w):
                self.by_bigram[g].append(w)
            for n in range(2, len(w)):
                self.by_prefix[w[:n]].append(w)
        self.initials: dict[str, dict[int, tuple[int, ...]]] = defaultdict(dict)
        for i, key in enumerate(self.keys):
            heavy = [k for k, w in enumerate(key) if w not in LIGHT and not w.isdigit()]
            for a in range(len(heavy)):
                for b in range(a + 2, min(a + 4, len(heavy)) + 1):
                    self.initials["".join(key[k][0] for k in heavy[a:b])].setdefault(i, tuple(heavy[a:b]))
        self.squashed: dict[str, str] = {}
        self.squashed_by_bigram: dict[tuple[str, int], list[str]] = defaultdict(list)
        for key, term in self.terms.items():
            if self.squashed.setdefault("".join(key), term) == term:
                whole = "".join(key)
                for g in _bigrams(whole):
                    self.squashed_by_bigram[g, len(whole)].append(whole)
        self.weights = [[self.weigh(w) for w in key] for key in self.keys]
        self.memo: dict[str, list[tuple[str, float]]] = {}

    def _telling(self) -> set[str]:
        """Words whose exchange or removal turns a form into one of another entry."""
        gaps: dict[tuple[tuple[str, ...], int], set[tuple[str, str]]] = defaultdict(set)
        for key, term in self.terms.items():
            for k, w in enumerate(key):
                gaps[key[:k] + key[k + 1 :], k].add((w, term))
        out = set()
        for (rest, _), found in gaps.items():
            if rest and (len({t for _, t in found}) > 1 or any(self.terms.get(rest, t) != t for _, t in found)):
                out |= {w for w, _ in found if w not in LIGHT and not w.isdigit()}
        return out

    def weigh(self, word: str) -> float:
        return LIGHT_WEIGHT if word in LIGHT else TELLING_WEIGHT if word in self.telling else 1.0

    def near(self, token: str) -> list[tuple[str, float]]:
        """Words of the list that a token may stand for, and how well."""
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) >= REMEMBER:
                self.memo.clear()
            found = self.memo[token] = self._near(token)
        return found

    def _near(self, token: str) -> list[tuple[str, float]]:
        if token.isdigit() or len(token) < 2:
            return [(token, 1.0)] if token in self.holding else []
        shared: dict[str, int] = defaultdict(int)
        for g in _bigrams(token):
            for w in self.by_bigram.get(g, ()):
                shared[w] += 1
        # a typing error spoils two bigrams; words of another first letter must have the rest
        least = 1 if len(token) <= 3 else 2 if len(token) <= 8 else 3
        maybe = {w for w, n in shared.items() if (w[0] == token[0] and n >= least) or n >= min(len(token), len(w)) - 3 and abs(len(token) - len(w)) <= 2}
        maybe.update(self.by_prefix.get(token, ()))
        if not any(c in "aeiou" for c in token[1:]):
            maybe.update(w for w in self.by_start.get(token[0], ()) if _inside(token, w))
        if token in self.holding:
            maybe.add(token)
        return [(w, s) for w in sorted(maybe) if (s := likeness(token, w)) > 0]

    def mentions(self, tokens: list[str]) -> tuple[list[str], list[tuple[int, str]]]:
        """(entries of the longest non-overlapping mentions, place and word of the tokens outside them)."""
        text = f" {' '.join(tokens)} "
        spans = []
        for end, (size, term) in self.automaton.iter(text):
            last = text.count(" ", 0, end) - 1  # index of the last word of the mention
            spans.append((size, last - size + 1, last, term))
        taken: list[tuple[int, int, str]] = []
        for _, first, last, term in sorted(spans, key=lambda s: (-s[0], s[1])):
            if all(last < a or first > b for a, b, _ in taken):
                taken.append((first, last, term))
        covered = {i for a, b, _ in taken for i in range(a, b + 1)}
        return [t for _, _, t in sorted(taken)], [(i, w) for i, w in enumerate(tokens) if i not in covered]

    def similarity(self, tokens: list[str], i: int) -> float:
        """Share of the weight of both sides that is matched, of the form ``i``."""
        key, weight = self.keys[i], self.weights[i]
        pairs, several = [], {}
        for k, t in enumerate(tokens):
            for w, s in self.near(t):
                pairs += [(s, k, j) for j, x in enumerate(key) if x == w]
            if len(t) > 1 and i in self.initials.get(t, ()):
                several[k] = self.initials[t][i]
        used_k, used_j, matched = set(), set(), 0.0
        size = sum(map(self.weigh, tokens))
        for k, js in several.items():
            if not used_j & set(js) and not any(p[0] == 1.0 and p[1] == k for p in pairs):
                used_k.add(k)
                used_j |= set(js)
                full = sum(weight[j] for j in js)
                matched += 0.97 * full
                size += full - self.weigh(tokens[k])
        for s, k, j in sorted(pairs, key=lambda p: (-p[0], abs(p[1] - p[2]))):
            if k not in used_k and j not in used_j:
                used_k.add(k)
                used_j.add(j)
                matched += s * weight[j]
        return 2 * matched / (size + sum(weight))

    def candidates(self, tokens: list[str]) -> set[int]:
        """Forms that can reach ``ACCEPT``.

        At most 1 - ACCEPT / (2 - ACCEPT) of the value's weight may stay unmatched, so a form holds one of
        any tokens that together weigh more; those of the fewest forms are taken.
        """
        places = []
        for t in tokens:
            holding: set[int] = set()
            for w, _ in self.near(t):
                holding |= self.holding[w]
            places.append((len(holding), self.weigh(t), holding))
        # a matched word may weigh more than the token that stands for it
        spare = (1 - ACCEPT / (2 - ACCEPT)) * sum(max(w, TELLING_WEIGHT) for _, w, _ in places)
        out: set[int] = set()
        for t in tokens:
            if len(t) > 1:
                out.update(self.initials.get(t, ()))
        for _, weight, holding in sorted(places, key=lambda p: p[0]):
            if spare < 0:
                break
            out |= holding
            spare -= weight
        return out

    def split_up(self, token: str) -> list[str]:
        """A run-together token as words of the list, if it is exactly that."""
        if len(token) < 6 or len(token) > 200 or token in self.holding:
            return [token]
        best: list[list[str] | None] = [[]] + [None] * len(token)
        for j in range(1, len(token) + 1):
            for i in range(j):
                if best[i] is not None and token[i:j] in self.holding and (best[j] is None or len(best[j]) > len(best[i]) + 1):
                    best[j] = [*best[i], token[i:j]]
        return best[-1] or [token]

    def run_together(self, whole: str) -> Iterator[tuple[str, float]]:
        """(entry, similarity) of the forms that resemble ``whole`` as one word."""
        n, grams = len(whole), _bigrams(whole)
        for size in range(max(5, int(n * 0.73)), int(n / 0.73) + 2):
            most = int(max(size, n) * 0.27)
            shared: dict[str, int] = defaultdict(int)
            for g in grams:
                for form in self.squashed_by_bigram.get((g, size), ()):
                    shared[form] += 1
            for form, k in shared.items():
                if k >= n // 3 and (d := edits(whole, form, most)) <= most and (form[0] == whole[0] or d <= 1):
                    yield self.squashed[form], 1 - 1.0 * d / size

    def is_missing(self, value: str) -> bool:
        plain = value.strip().lower()
        return plain in STAND_INS or plain.strip(" .:;,") in STAND_INS

    def lesson(self, value: str) -> list[tuple[str, str, str, str]]:
        """(kind, token, word, entry) that a value tells about remarks and abbreviations."""
        if not self.keys or self.is_missing(value) or not (tokens := words(value, self.ordinal)):
            return []
        named, rest = self.mentions(tokens)
        out = []
        if len(set(named)) == 1 and rest:
            out += [("remark", w, "", named[0]) for _, w in rest]
            # consecutive words beside a mention, for values written without spaces
            run = [rest[0][1]]
            for (i, _), (j, w) in zip(rest, rest[1:], strict=False):
                run = [*run, w] if j == i + 1 else [w]
                if len(run) > 1:
                    out.append(("run", "".join(run), "", named[0]))
        known = [t for t in tokens if t in self.holding]
        if known and len(known) < len(tokens):
            odd = [t for t in tokens if t not in self.holding and t[0].isalpha() and len(t) <= 3]
            forms = set.intersection(*(self.holding[t] for t in known))
            for i in forms if odd else ():
                left = list(self.keys[i])
                for t in known:
                    if t in left:
                        left.remove(t)
                left = [w for w in left if w not in LIGHT]
                if len(left) == 1:
                    out += [("short", t, left[0], self.terms[self.keys[i]]) for t in odd if t[0] == left[0][0]]
        return out


class Mapper:
    """Maps the values of one field, given what was learnt about how people write."""

    def __init__(self, forms: Forms, remarks: Mapping[str, int], runs: set[str], short: Mapping[str, str]):
        self.forms, self.short = forms, short
        # what resembles a word of the list must stand beside most entries to be a remark
        most = len(set(forms.terms.values())) / 2
        self.remarks = {r for r, entries in remarks.items() if r not in forms.holding and (entries >= most or len(r) < 2 or not any(s >= 0.8 for _, s in forms.near(r)))}
        self.runs = sorted(runs | {r for r in self.remarks if len(r) > 4}, key=len, reverse=True)
        self.long_remarks: dict[tuple[str, int], list[str]] = defaultdict(list)
        for r in self.remarks:
            if len(r) > 4:
                for n in range(len(r) - 2, len(r) + 3):
                    self.long_remarks[r[0], n].append(r)

    def remark(self, token: str) -> bool:
        if token in self.remarks:
            return True
        return len(token) > 4 and any(edits(token, r, 2) <= (1 if len(r) < 8 else 2) for r in self.long_remarks.get((token[0], len(token)), ()))

    def map(self, value: str) -> str:
        return self.explain(value)[0]

    def explain(self, value: str) -> tuple[str, str]:
        """(entry, "mention", "similarity" or "none")."""
        forms = self.forms
        if not forms.keys or forms.is_missing(value) or not (tokens := words(value, forms.ordinal)):
            return NONE, "none"
        named, rest = forms.mentions(tokens)
        one = len(set(named)) == 1
        if one and not any(self._speaks(w) for _, w in rest):
            return named[0], "mention"
        full = [x for t in tokens for x in (self.short[t].split() if t in self.short and t not in forms.holding else forms.split_up(t))]
        content = [t for t in full if t in forms.holding or not self.remark(t)]
        scores: dict[str, float] = {}
        for i in forms.candidates(content):
            s = forms.similarity(content, i)
            term = forms.terms[forms.keys[i]]
            if s > scores.get(term, 0.0):
                scores[term] = s
        whole = "".join(content)
        for r in self.runs:
            if r in whole:
                whole = whole.replace(r, "")
        if 5 <= len(whole) <= 400 and max(scores.values(), default=0.0) < SURE:
            for term, s in forms.run_together(whole):
                if s > scores.get(term, 0.0):
                    scores[term] = s
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
        if ranked and ranked[0][1] >= ACCEPT and (len(ranked) == 1 or ranked[0][1] - ranked[1][1] >= LEAD):
            return ranked[0][0], "similarity"
        return NONE, "none"

    def _speaks(self, token: str) -> bool:
        """Whether a word beside a mention may say something about the entry."""
        if token in LIGHT or self.remark(token):
            return False
        forms = self.forms
        if token in self.short or token in forms.initials or forms.near(token) or (token.isalpha() and len(token) == 1) or forms.split_up(token) != [token]:
            return True
        return any(r in token and token.replace(r, "") in forms.holding for r in self.runs)


def learn(values: DataFrame, shared: object) -> DataFrame:
    """(kind, field_name, token, word, n_entries, n) over all distinct values."""

    def lessons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forms = once(shared, _forms)
        for batch in batches:
            rows: dict[tuple[str, ...], int] = defaultdict(int)
            for f, v in zip(batch["field_name"], batch["value"], strict=True):
                for lesson in forms[f].lesson(v):
                    rows[f, *lesson] += 1
            yield pd.DataFrame([(*r, n) for r, n in rows.items()], columns=["field_name", "kind", "token", "word", "entry", "n"])

    told = values.mapInPandas(lessons, "field_name string, kind string, token string, word string, entry string, n long")
    return told.groupBy("kind", "field_name", "token", "word").agg(F.count_distinct("entry").alias("n_entries"), F.sum("n").alias("n"))


def _forms(listed: dict[str, list[tuple[str, str]]]) -> dict[str, Forms]:
    return {f: Forms(forms, f in ORDINAL) for f, forms in listed.items()}


def mappers(listed: dict[str, list[tuple[str, str]]], lessons: list[tuple[str, str, str, str, int, int]], short: Mapping[str, str]) -> dict[str, Mapper]:
    """A mapper per field from the lessons (kind, field, token, word, entries, values)."""
    out = {}
    for f, forms in _forms(listed).items():
        of_field = [x for x in lessons if x[1] == f]
        remarks = {t: (entries, n) for kind, _, t, _, entries, n in of_field if kind == "remark" and entries >= LEAST_ENTRIES}
        runs = {t for kind, _, t, _, entries, _ in of_field if kind == "run" and entries >= LEAST_ENTRIES}
        places: dict[str, dict[str, tuple[int, int]]] = defaultdict(dict)
        for kind, _, t, w, entries, n in of_field:
            if kind == "short":
                places[t][w] = (n, entries)
        found = dict(short)
        for t, words_of in places.items():
            w, (n, entries) = max(words_of.items(), key=lambda x: (x[1], x[0]))
            if entries >= LEAST_ENTRIES and n >= LEAST_SHARE * sum(n for n, _ in words_of.values()) and n > remarks.get(t, (0, 0))[1]:
                found.setdefault(t, w)
        out[f] = Mapper(forms, {t: entries for t, (entries, _) in remarks.items() if t not in found}, runs, found)
    return out


def map_values(df: DataFrame, terms: DataFrame, key: str, fields: list[str], also: Mapping[str, list[str]] | None = None, short: Mapping[str, str] | None = None) -> DataFrame:
    """(key, field_name, value, term_id) of every cell that is not blank and no exact form.

    ``also`` gives further forms by term_id, ``short`` abbreviations known beforehand.
    """
    also, short = also or {}, short or {}
    rows = collect_bounded(terms.select("term_id", "field_name", "term", "synonyms"), MAX_TERMS, "the canonical list")
    exact: dict[str, set[str]] = {f: set() for f in fields}
    listed: dict[str, list[tuple[str, str]]] = {f: [] for f in fields}
    for r in rows:
        if r["field_name"] in listed:
            own = [x for x in [r["term"], *(r["synonyms"] or [])] if x]
            exact[r["field_name"]] |= set(own)
            listed[r["field_name"]] += [(r["term_id"], x) for x in [*own, *also.get(r["term_id"], ())]]
    spark = df.sparkSession
    known = spark.createDataFrame([(f, x) for f in fields for x in sorted(exact[f])], "field_name string, value string")
    pairs = ", ".join(f"'{f}', cast(`{f}` as string)" for f in fields)
    cells = df.select(*dict.fromkeys([key, *fields])).selectExpr(f"`{key}` as key", f"stack({len(fields)}, {pairs}) as (field_name, value)").where(r"value is not null and value rlike '(?U)[^\\s\\x1c-\\x1f]'")
    open_cells = cells.join(F.broadcast(known), ["field_name", "value"], "left_anti")
    values = cut(open_cells.select("field_name", "value").distinct())  # read twice: to learn from, and to map
    shared = spark.sparkContext.broadcast(listed)
    lessons = [tuple(r) for r in collect_bounded(learn(values, shared).where((F.col("n_entries") >= LEAST_ENTRIES) | (F.col("kind") == "short")), MAX_LEARNT, "what was learnt from the values")]
    learnt = spark.sparkContext.broadcast((listed, lessons, dict(short)))

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = once(learnt, lambda v: mappers(*v))
        for batch in batches:
            yield batch.assign(term_id=[found[f].map(v) for f, v in zip(batch["field_name"], batch["value"], strict=True)])

    done = spread(values).mapInPandas(mapped, "field_name string, value string, term_id string")
    return open_cells.join(done, ["field_name", "value"]).select(F.col("key").alias(key), "field_name", "value", "term_id")
