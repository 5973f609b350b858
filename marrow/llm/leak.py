"""Held-out test items that leaked, fully or partly, into training texts.

One Aho-Corasick automaton holds every run of ``SEED`` normalised words of every item; each
text is scanned once by it. Texts are normalised without losing their offsets: markup,
entities, quote marks, case, accents and punctuation don't matter. For an item with
a seed in a text, the exact check follows: runs of equal words are chained in item
order, words changed, dropped or added cost an edit, and a stretch of foreign text may
interrupt the item. A chain counts if it spans the item's ``min_words`` words (or the
whole item, if shorter) with about one edit in eight words.

The test items are small by their meaning (checked, ``MAX_ITEMS``) and broadcast; texts
are never shuffled, so hot threads or repeated posts don't matter.

Defined cases: null, empty and blank texts and items match nothing; items with fewer than
``SEED`` words are matched as a whole run of words; an item listed twice is reported under
each id; repeated rows are reported each for itself; a text is scanned whole.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marrow.operators.bounded import collect_bounded
from marrow.session import once, spread

MAX_ITEMS = 200_000
SEED = 3
#: Cost of a changed, dropped or added word, and of an interruption, in matched words.
EDIT, INTERRUPTION = 1.5, 2.0
#: Share of a chain's span that must match word by word.
LEAST_SHARE = 0.8
#: Words on each side of an interruption, and most words changed, dropped or added in a row.
LEAST_PART, MOST_GAP = 5, 3
_MARKUP = re.compile(r"<[/!]?[a-zA-Z][^<>]{0,300}>|\[/?[a-zA-Z*][^\[\]\n]{0,80}\]|&(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[a-zA-Z]{2,12});?")
_WORD = re.compile(r"[^\W_][\ẁ-ͯ­​-‍]*")
_NOISE = re.compile(r"[̀-ͯ­​-‍_]")


def _plain(text: str) -> tuple[str, list[int] | None]:
    """Text with markup as spaces and entities resolved, and the original offset of each character."""
    if "<" not in text and "[" not in text and "&" not in text:
        return text, None
    out, at, last = [], [], 0
    for m in _MARKUP.finditer(text):
        out.append(text[last : m.start()])
        at.extend(range(last, m.start()))
        shown = html.unescape(m.group()) if m.group()[0] == "&" else " "
        out.append(shown)
        at.extend([m.start()] * len(shown))
        last = m.end()
    out.append(text[last:])
    at.extend(range(last, len(text) + 1))
    return "".join(out), at


def normalised(text: str) -> tuple[list[str], list[int], list[int]]:
    """Words in comparison form, with the offsets in ``text`` where each starts and ends."""
    plain, at = _plain(text)
    out, starts, stops = [], [], []
    for m in _WORD.finditer(plain):
        w = m.group()
        w = w.lower() if w.isascii() else _NOISE.sub("", unicodedata.normalize("NFKD", w.casefold()))
        for part in w.split("_") if "_" in w else (w,):
            if part:
                out.append(part)
                starts.append(at[m.start()] if at else m.start())
                stops.append(at[m.end() - 1] + 1 if at else m.end())
    return out, starts, stops


class LeakFinder:
    """Finds the items of one list in texts; made once per Python worker."""

    def __init__(self, items: list[tuple[int, str | None]], min_words: int):
        import ahocorasick

        self.min_words = min_words
        self.items = {i: w for i, t in items if t and (w := normalised(t)[0])}
        self.places = {i: self._places(w) for i, w in self.items.items()}
        seeds: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for i, w in self.items.items():
            n = min(SEED, len(w))
            for p in range(len(w) - n + 1):
                seeds[f" {' '.join(w[p : p + n])} "].append((i, p, n))
        self.automaton = ahocorasick.Automaton()
        for seed, where in seeds.items():
            self.automaton.add_word(seed, where)
        if seeds:
            self.automaton.make_automaton()

    @staticmethod
    def _places(words: list[str]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            out[w].append(p)
        return dict(out)

    def find(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item, start, stop, words spanned, words matched) of every leaked item; offsets in ``text``."""
        if not text or not self.items:
            return []
        words, starts, stops = normalised(text)
        line = f" {' '.join(words)} "
        ends = [0]
        for w in words:
            ends.append(ends[-1] + len(w) + 1)  # where the space after word k stands
        places: dict[int, list[int]] = defaultdict(list)
        for end, where in self.automaton.iter(line):
            last = bisect_left(ends, end)
            for item, p, n in where:
                places[item].append(last - n)
        out: list[tuple[int, int, int, int, int]] = []
        used: dict[int, set[int]] = {}
        for item in places:
            need = min(self.min_words, len(self.items[item]))
            hit = self._chain(item, words, places[item], need)
            if hit:
                q0, q1, span, matched, used[item] = hit
                out.append((item, starts[q0], stops[q1 - 1], span, matched))

        def explained(h: tuple[int, int, int, int, int], g: tuple[int, int, int, int, int]) -> bool:
            """Whether most words of ``h`` are matched by ``g``, which has more, and the others don't make a case."""
            shared = used[h[0]] & used[g[0]]
            if g[4] <= h[4] or len(shared) <= h[4] / 2:
                return False
            rest = [None if q in used[g[0]] else w for q, w in enumerate(words)]
            return self._chain(h[0], rest, places[h[0]], min(self.min_words, len(self.items[h[0]]))) is None

        # test items share phrases: a passage belongs to the item that explains most of it
        return sorted(h for h in out if not any(g[0] != h[0] and explained(h, g) for g in out))

    def _chain(self, item: int, words: list[str | None], seeds: list[int], need: int) -> tuple[int, int, int, int, set[int]] | None:
        """(first word, word after the last, words spanned, words matched, places of the matched ones) in the text."""
        target, places = self.items[item], self.places[item]
        near = sorted({q for s in seeds for q in range(max(0, s - 4), min(len(words), s + SEED + 4))})
        runs, open_runs = [], {}
        last_q = -2
        for q in near:
            if q != last_q + 1:
                runs += open_runs.values()
                open_runs = {}
            grown = {}
            for p in places.get(words[q], ()):
                run = open_runs.pop(p - 1, None)
                grown[p] = [run[0], run[1], run[2] + 1] if run else [p, q, 1]
            runs += open_runs.values()
            open_runs, last_q = grown, q
        runs += open_runs.values()
        alone = 1 if need < 2 else 2
        runs = sorted(((p, q, n) for p, q, n in runs if n >= alone), key=lambda r: (r[1], r[0]))
        # (score, matched, first p, first q, matched since the last interruption, words of the text used)
        best: list[tuple[float, int, int, int, int, int]] = []
        back: list[tuple[int, int]] = []  # the run before, and the words cut off this one
        found = None
        # Runs are taken in text order. Those that end near by are looked up by where they end in the text; of
        # those further back only the best that ends at each word of the item matters, whatever stands between.
        by_text_end: dict[int, list[int]] = defaultdict(list)
        far: dict[int, int] = {}
        waiting: deque[int] = deque()
        for k, (p, q, n) in enumerate(runs):
            while waiting and runs[waiting[0]][1] + runs[waiting[0]][2] + MOST_GAP < q:
                j = waiting.popleft()
                end = runs[j][0] + runs[j][2]
                if best[j][4] >= LEAST_PART and (end not in far or best[far[end]][0] < best[j][0]):
                    far[end] = j
            top, before = (float(n), n, p, q, n, n), (-1, 0)
            near_by = [j for at in range(q - MOST_GAP, q + n) for j in by_text_end.get(at, ())]
            further = [far[at] for at in range(p - MOST_GAP, p + n) if at in far]
            for j in near_by + further:
                (jp, jq, jn), b = runs[j], best[j]
                skip = max(jp + jn - p, jq + jn - q, 0)  # overlapping ends are cut off the later run
                if skip >= n or p <= jp or q <= jq:
                    continue
                gap_p, gap_q = p + skip - jp - jn, q + skip - jq - jn
                if gap_p > MOST_GAP:
                    continue
                if gap_q <= MOST_GAP:
                    score, since, used = b[0] + n - skip - EDIT * max(gap_p, gap_q), b[4] + n - skip, b[5] + n - skip + max(gap_p, gap_q)
                elif b[4] >= LEAST_PART:
                    score, since, used = b[0] + n - skip - EDIT * gap_p - INTERRUPTION, n - skip, b[5] + n - skip + gap_p
                else:
                    continue
                if score > top[0]:
                    top, before = (score, b[1] + n - skip, b[2], b[3], since, used), (j, skip)
            best.append(top)
            back.append(before)
            by_text_end[q + n].append(k)
            waiting.append(k)
            span = p + n - top[2]
            if span >= need and top[1] >= LEAST_SHARE * max(span, top[5]) and top[4] >= min(LEAST_PART, need) and (found is None or top[1] > found[3]):
                found = (top[3], q + n, span, top[1], len(back) - 1)
        if found is None:
            return None
        matched: set[int] = set()
        k = found[4]
        while k >= 0:
            (_, q, n), (j, skip) = runs[k], back[k]
            matched.update(range(q + skip, q + n))
            k = j
        return (*found[:4], matched)


def find_leaks(df: DataFrame, items: DataFrame, key: str, text: str = "text", item_key: str = "item_id", item_text: str = "text", min_words: int = 12) -> DataFrame:
    """(key, item_id, start, stop, n_words, n_matched) of every leaked item in every text."""
    listed = [(r["i"], r["t"]) for r in collect_bounded(items.select(F.col(f"`{item_key}`").alias("i"), F.col(f"`{item_text}`").alias("t")), MAX_ITEMS, "the table of test items")]
    shared = df.sparkSession.sparkContext.broadcast(listed)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = once(shared, lambda listed: LeakFinder(listed, min_words))
        for batch in batches:
            rows = [(k, *hit) for k, t in zip(batch["key"], batch["text"], strict=True) for hit in finder.find(t)]
            yield pd.DataFrame(rows, columns=["key", "item_id", "start", "stop", "n_words", "n_matched"])

    body = spread(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))).where("text is not null")
    kind = dict(body.dtypes)["key"]
    return body.mapInPandas(scan, f"key {kind}, item_id long, start long, stop long, n_words int, n_matched int").withColumnRenamed("key", key)
