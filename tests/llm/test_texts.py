import copy
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marrow.llm import encode, langid, leak, ocr, split, token_budget
from marrow.llm.vocab import BYTE_BPE_50K, PATTERN, read_ranks

ODD = [None, "", "   ", "a", "\r\n \n\n\nx\n", "<|endoftext|> don't  stop\t\x00\x01\x1c", "naïve 日本語 🔬🔬 1234567", "w " * 3000, "a" * 20_000, "x\n\ny z \n", " lead", "trail \n\n"]


def corpus(spark, texts, extra="key string, own string, piece string"):
    schema = f"record_id long, report_id string, text string, lang string, {extra}"
    return spark.createDataFrame([(i, f"R{i}", t, "en", "k", "o", "p") for i, t in enumerate(texts)], schema)


@pytest.fixture(scope="module")
def reference_tokens():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(BYTE_BPE_50K.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizer_and_decode_back(spark, reference_tokens):
    got = {r.record_id: list(r.ids) for r in encode.encode(corpus(spark, ODD)).collect()}
    assert [got[i] for i in range(len(ODD))] == reference_tokens(ODD)
    ranks = read_ranks(BYTE_BPE_50K)
    assert all(encode.decode(got[i], ranks) == (t or "") for i, t in enumerate(ODD)) and got[0] == []
    assert encode.encode(corpus(spark, [])).count() == 0


@pytest.mark.parametrize("kept", [400_000, 3])
def test_counts_equal_the_tokenizer(spark, reference_tokens, monkeypatch, kept):
    monkeypatch.setattr(token_budget, "REMEMBER", kept)
    counter = token_budget.TokenCounter(read_ranks(BYTE_BPE_50K))
    want = [len(x) for x in reference_tokens(ODD)]
    assert [counter.count([t])[0] for t in ODD] == counter.count(ODD) == want
    got = token_budget.count_tokens(corpus(spark, ODD + ODD), ["record_id", "key"]).collect()
    assert {r.record_id: r.n_tokens for r in got} == dict(enumerate(want + want)) and {r.key for r in got} == {"k"}
    assert token_budget.count_tokens(corpus(spark, []), ["record_id"]).count() == 0


def test_merges_equal_a_plain_merge_loop():
    ranks = read_ranks(BYTE_BPE_50K)
    codes, merged = token_budget.merge_table(ranks)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not pairs:
                return len(parts)
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    r = random.Random(3)
    pieces = ["".join(r.choice("abeinst rü-9") for _ in range(r.randint(1, 25))).encode() for _ in range(400)] + [b"aaaaaaa", b"aaaa", b"-" * 71]
    assert token_budget.merged_lengths(pieces, single, codes, merged).tolist() == [plain(p) for p in pieces]


def test_totals_count_dirty_labels(spark):
    df = corpus(spark, ["a b", "a", None]).withColumn("lang", F.when(F.col("record_id") == 0, " EN\t").when(F.col("record_id") == 1, "en"))
    out = token_budget.totals(df, ["lang"]).collect()
    assert sorted((r.lang, r.n_texts, r.n_tokens) for r in out) == [("en", 2, 3), ("unknown", 1, 0)]


SPECS = "spec_id int, unit string, max_size long, overlap_size long"


@pytest.mark.parametrize(("unit", "limit", "overlap"), [("chars", 300, 40), ("bytes", 300, 0), ("bytes", 300, 60), ("chars", 64, 32)])
def test_pieces_cover_the_text_within_the_limit(spark, unit, limit, overlap):
    r = random.Random(5)
    words = ["Tumor", "größe", "lung", "日本語", "x", "margin.", "clear.\n", "nodes\r\n\r\n", "Ende!\n\n", "🔬"]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (1, 40, 400, 3000)] + ["y" * 5000, "🔬" * 700, " " * 1000, "a\r\n" * 500, None, ""]
    df = corpus(spark, texts)
    specs = spark.createDataFrame([(1, unit, limit, overlap)], SPECS)
    size = (lambda s: len(s.encode())) if unit == "bytes" else len
    pieces = {}
    for p in split.split(df, specs, "record_id").orderBy("record_id", "piece_no").collect():
        pieces.setdefault(p.record_id, []).append(p)
    assert set(pieces) == {i for i, t in enumerate(texts) if t and size(t) > limit} == {x.record_id for x in split.oversized(df, specs, "record_id").collect()}
    for i, ps in pieces.items():
        assert ps[0].start == 0 and ps[-1].stop == len(texts[i]) and [p.piece_no for p in ps] == list(range(1, len(ps) + 1))
        for p in ps:
            assert p.text == texts[i][p.start : p.stop] and p.size == size(p.text) <= limit
        for a, b in zip(ps, ps[1:], strict=False):
            shared = texts[i][b.start : a.stop]
            assert size(shared) == overlap if unit == "chars" else overlap - 4 < size(shared) <= overlap
            assert not (overlap == 0 and texts[i][b.start - 1 : b.start + 1] == "\r\n")


def test_cuts_fall_at_topic_changes_and_bad_specs_fail(spark):
    a, b = "The lung lobe shows tumour cells near the lung pleura. " * 6, "Invoices are paid by bank transfer within thirty days. " * 6
    text = a + b
    cut = split.cut_points(text, 500, 0, False)
    assert cut[0][1] == len(a)
    with pytest.raises(ValueError, match="overlap"):
        split.cut_points("x" * 100, 20, 15, False)
    with pytest.raises(Exception, match="unknown unit"):
        split.split(corpus(spark, ["x"]), spark.createDataFrame([(1, "lines", 5, 0)], SPECS), "record_id")


def test_valleys_equal_direct_block_similarity():
    r = random.Random(2)
    units = [[r.choice("abcdefgh") for _ in range(r.randint(0, 6))] for _ in range(700)]
    from collections import Counter

    def direct(i):
        left, right = (sum((Counter(u) for u in part), Counter()) for part in (units[max(0, i + 1 - split.BLOCK) : i + 1], units[i + 1 : i + 1 + split.BLOCK]))
        norm = (sum(v * v for v in left.values()) * sum(v * v for v in right.values())) ** 0.5
        return sum(v * right[w] for w, v in left.items()) / norm if norm else 0.0

    scores = [direct(i) for i in range(len(units) - 1)]
    depth = [max(scores[max(0, i - split.BLOCK) : i + 1]) + max(scores[i : i + split.BLOCK + 1]) - 2 * scores[i] for i in range(len(scores))]
    assert np.allclose(split.valleys(units), depth)


ITEM = "A fixed wedge imitates the outer capsule after bleaching while every nucleus crosses one hilar node near the pleura and spares all margins today"
OTHER = "Le bord sans encre imite la réaction pâle près du vaisseau et donc la capsule externe entoure chaque noyau avant toute décalcification finale"


def leaks(spark, texts, items=((1, ITEM), (2, OTHER), (3, None), (4, ""), (5, "Short one"))):
    out = leak.find_leaks(corpus(spark, texts), spark.createDataFrame(list(items), "item_id long, text string"), "record_id").collect()
    return {(r.record_id, r.item_id) for r in out}, out


def test_leaks(spark):
    w = ITEM.split()
    changed = [*w]
    changed[5], changed[13] = "other", "thing"
    texts = [
        ITEM,
        ITEM.upper().replace(" ", "\n> "),
        "<p>" + " ".join(f"<b>{x}</b>" for x in w) + "</p>",
        "intro " + " ".join(w[4:16]) + " outro",
        "intro " + " ".join(w[4:12]) + " outro",
        " ".join(changed),
        " ".join(w[:9]) + ". Somebody wrote here at length about other things entirely and more. " + " ".join(w[9:]),
        OTHER.replace("é", "e&#768;").replace("e&#768;", "&eacute;"),
        OTHER.replace("é", "e").replace("â", "a"),
        " ".join(reversed(w)),
        None, "", "   ", "filler " * 20_000 + ITEM,
        "I say Short one here",
    ]
    got, rows = leaks(spark, texts)
    assert got == {(0, 1), (1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (7, 2), (8, 2), (13, 1), (14, 5)}
    span = next(r for r in rows if r.record_id == 13)
    assert texts[13][span.start : span.stop] == ITEM
    assert leaks(spark, [])[0] == set() and leaks(spark, [ITEM], [(1, None)])[0] == set()
    assert leaks(spark, [ITEM, ITEM], [(1, ITEM), (9, ITEM)])[0] == {(0, 1), (0, 9), (1, 1), (1, 9)}


def test_an_item_within_another_is_found_besides_it(spark):
    a, b = ITEM.split(), OTHER.split()
    texts = [
        " ".join([*a[:12], *b, *a[12:]]),
        " ".join([*b[:11], *a, *b[11:]]),
        " ".join([*a[:7], *b, *a[7:16]]),
        " ".join([*a[:12], *b[:13], *a[12:]]),
    ]
    assert leaks(spark, texts)[0] == {(i, k) for i in range(4) for k in (1, 2)}
    near = " ".join([*a[:16], "but", "other", "words", "follow", "here"])
    assert leaks(spark, [ITEM], [(1, ITEM), (2, near)])[0] == {(0, 1)}  # a shared passage goes to one


SENTENCES = {
    "en": ["The new machine keeps losing every slide after lunch.", "Nobody cleaned the filter before we started the run.", "Could you post which settings you use for this?"],
    "de": ["Die neue Maschine verliert nach dem Essen jeden Schnitt.", "Niemand hat den Filter gereinigt bevor wir anfingen.", "Könntet ihr bitte eure Einstellungen hier einstellen?"],
    "fr": ["La nouvelle machine perd toutes les lames après le repas.", "Personne n'avait nettoyé le filtre avant de commencer.", "Pourrais-tu donner ici les réglages que tu utilises?"],
    "es": ["La máquina nueva pierde todos los cortes después de comer.", "Nadie había limpiado el filtro antes de empezar la serie.", "¿Podrías poner aquí los ajustes que usas para esto?"],
}


@pytest.fixture(scope="module")
def prototypes():
    parts = [([langid.fold(w) for w in re.findall(r"[^\W\d_]+", s)], c) for c, ss in SENTENCES.items() for s in ss]
    return langid.Prototypes.fit(parts * 3)


def test_labels_and_segments(spark, prototypes):
    texts = [
        (SENTENCES["en"][0], "en"), (SENTENCES["en"][1], "EN_us"), (SENTENCES["de"][0], "en"), (SENTENCES["fr"][1], None), (SENTENCES["es"][1], "und"),
        (SENTENCES["en"][0] + " " + SENTENCES["de"][1], "English"), ("[deleted]", None), ("def f(x): return {'a': [1, 2]}", "en"), ("https://a.b/c", ""),
        (None, "en"), ("", None), ("  ", "de"), ("too few words here", "de"), (SENTENCES["en"][0] + "\n-- \nDie Signatur zählt hier gar nicht mit", "en"),
        ("a wrote:\n> " + SENTENCES["fr"][0] + "\n\n" + SENTENCES["fr"][2], "fra"), (" ".join(SENTENCES["es"] * 400), "Spanish"),
    ]
    df = spark.createDataFrame([(i, t, lab, "x") for i, (t, lab) in enumerate(texts)], "doc_id long, text string, lang string, label string")
    got = {(r.doc_id, r.lang) for r in langid.relabelled(df, "doc_id", prototypes=prototypes).collect()}
    assert got == {(2, "de"), (3, "fr"), (4, "es"), (5, "en"), (5, "de")}
    parts = [r for r in langid.identify(df, "doc_id", prototypes=prototypes).collect() if r.doc_id == 5]
    assert [(p.lang, p.n_words) for p in sorted(parts, key=lambda p: p.segment_no)] == [("en", 9), ("de", 8)] and all(0.5 < p.confidence <= 1 for p in parts)
    assert langid.relabelled(df.limit(0), "doc_id", prototypes=prototypes).count() == 0


def words_of(text):
    return [words for words, _ in langid.prose(text)]


def test_only_signatures_are_left_out_below_rules():
    flat = lambda t: " ".join(w for p in words_of(t) for w in p)
    assert flat("Résumé\n------\nLa machine est en panne. Personne ne sait pourquoi.\nOn attend.") == "Résumé La machine est en panne Personne ne sait pourquoi On attend"
    assert flat("Before.\n***\nAfter the rule the post goes on\n\nand on.") == "Before After the rule the post goes on and on"
    assert flat("Text.\n-- \nBest wishes.\nAnna, lab") == "Text" and flat("Text.\n___\nCheers from the bench") == "Text"
    assert flat("> Text.\n> -----\n> Anna, lab\nThe answer stands here") == "Text The answer stands here"
    long = "Rindfleischetikettierungsüberwachungsaufgabenübertragungsgesetz"
    assert flat(f"Das {long} gilt a1b2c3d4e5f6a1b2c3d4e5f6a1b2c3d4e5f6") == f"Das {long} gilt"


def test_prose_beside_signs_of_code_stays(spark, prototypes):
    words = words_of
    assert words("I m@de 48 credits @ week, @sk me @@n mit@d\nname@lab.org 5 @ 3") == [["I", "m@de", "credits", "@", "week", "@sk", "me", "@@n", "mit@d"]]
    assert words("Bitte {x: [1, 2]} setzen; danach läuft es -> wieder") == [["Bitte", "setzen", "danach", "läuft", "es", "wieder"]]
    for code in ("def f(x): return {'a': [1, 2]}", "if x_1 >= 16:\n    return {'a': [0, 5]}", "int count = total + offset;", "SELECT name FROM t WHERE age >= 5 AND x = 3;"):
        assert words(code) == []
    assert langid.fold("Che@p") == "cheap"
    df = spark.createDataFrame([(1, "Nobody cle@ned the filter before we st@rted the run @nd s@ve", None), (2, "Niemand hat den Filter gereinigt bevor wir anfingen {a: [1]}; {b = 2}", "en")], "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang) for r in langid.relabelled(df, "doc_id", prototypes=prototypes).collect()} == {(1, "en"), (2, "de")}


def test_a_post_without_a_sure_segment_has_its_surest(spark, prototypes):
    texts = [(SENTENCES["fr"][0], None), (SENTENCES["fr"][0], "fr"), (SENTENCES["de"][1] + "\n\n" + SENTENCES["fr"][0], "de"), (SENTENCES["fr"][0], "en")]
    df = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(texts)], "doc_id long, text string, lang string")
    unsure = copy.copy(prototypes)
    unsure.temperature = 0.3  # no lead is that wide
    parts = langid.identify(df, "doc_id", prototypes=unsure).where("doc_id < 2").collect()
    assert parts and all(p.n_words >= langid.MIN_WORDS and p.confidence < langid.MIN_CONFIDENCE for p in parts)
    out = {(r.doc_id, r.lang): r.confidence for r in langid.relabelled(df, "doc_id", prototypes=unsure).collect()}
    assert {(0, "fr"), (3, "fr")} <= set(out) and not any(d == 1 for d, _ in out) and out[0, "fr"] < langid.MIN_CONFIDENCE


def test_label_forms():
    assert [langid.language_of_label(x) for x in ("pt-BR", "NLD", "German", "xx", "", None, " fr ")] == ["pt", "nl", "de", None, None, None, "fr"]


def test_held_out_passages_are_named_right(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    model = langid.fit_prototypes(docs.where("doc_id % 2 = 0"), "doc_id")
    judge = langid.Judge(model)
    right = total = 0
    for r in docs.where("doc_id % 2 = 1 and text is not null").collect():
        code = langid.language_of_label(r.lang)
        found = {s[0] for s in judge.segments(r.text) if s[1] >= 5}
        if code and len(found) == 1:
            total += 1
            right += found == {code}
    assert total > 200 and right / total > 0.9  # about one label in twenty is wrong
    foreign = {
        "pl": "Każdy człowiek ma prawo do życia oraz wolności i bezpieczeństwa swojej osoby", "sv": "Alla människor är födda fria och lika i värde och rättigheter",
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "ro": "Toate ființele umane se nasc libere și egale în demnitate și în drepturi",
    }
    assert {s[0] for t in foreign.values() for s in judge.segments(t)} == {langid.OTHER}


def test_vectors_scores_and_paths_equal_their_definitions(prototypes):
    code, owner = langid.ngrams(["ab", "z"])
    text = lambda c: "".join(chr(int(c) >> 16 * k & 0xFFFF) for k in range(4) if int(c) >> 16 * k & 0xFFFF)
    assert sorted(text(c) for c in code[owner == 0]) == sorted(["a", "b", " a", "ab", "b ", " ab", "ab ", " ab "]) and sorted(text(c) for c in code[owner == 1]) == sorted(["z", " z", "z ", " z "])
    space, judge = langid.Space(), langid.Judge(prototypes)
    words = ["machine", "nouvelle", "the", "machine"]
    rows = [judge.row(w) for w in words]
    bundle = sum(space.vectors(langid.ngrams([w])[0]).astype(float).sum(0) for w in words)
    exact = prototypes.vectors @ bundle / np.linalg.norm(bundle)
    assert np.allclose(judge.table[rows].sum(0), prototypes.vectors @ bundle, rtol=1e-3, atol=1) and np.allclose(judge.cosine(rows), exact, atol=0.02)
    r = np.random.default_rng(4)
    for n in (1, 2, 30, 200):
        for scale in (0.3, 1.5, 4):
            each, ended = r.normal(size=(n, 5)) * scale + np.repeat(r.normal(size=(n // 20 + 1, 5)), 20, 0)[:n], [bool(x) for x in r.integers(0, 2, n)]
            cost = lambda path, each=each, ended=ended, n=n: sum(each[i, k] for i, k in enumerate(path)) - sum((langid.SWITCH_END if ended[i] else langid.SWITCH_INSIDE) for i in range(n - 1) if path[i] != path[i + 1])
            path = [k for k, a, b in langid.Judge._runs(each, ended) for _ in range(a, b)]
            assert np.isclose(cost(path), cost(langid.Judge._decode(each.tolist(), ended)), atol=1e-4)


def noise_of(spark, texts, names=("Harrowgate Pathology Services",)):
    labs = spark.createDataFrame([(n,) for n in names], "lab_name string")
    return {(r.record_id, r.line_no, r.noise) for r in ocr.find_noise(corpus(spark, texts), labs).collect()}


CLEAN = "The tumour shows infiltrating glands and cords within a fibrous background.\nAn ill-defined nodule is palpable in the left breast region.\n"


def test_scanned_pages(spark):
    scan = "Harrowgate Pathology Services\nThe tumour shows infiltratlng glands and cords within a fibr-\n- 1 -\nHarrow|ate Pathology Services\nous background. An ill-\ndefined nodule is palpable in\n\nNodes examined:\n12\nthe 1eft breast region.\n~2~"
    texts = [CLEAN] * 60 + [scan, None, "", "  \n ", "z" * 9000, scan.replace("\n", "\r\n")]
    want = {(1, "running_header"), (2, "misread"), (2, "broken_word"), (3, "page_number"), (4, "running_header"), (10, "misread"), (11, "page_number")}
    assert noise_of(spark, texts) == {(i, n, k) for i in (60, 65) for n, k in want}
    labs = spark.createDataFrame([("Harrowgate Pathology Services",)], "lab_name string")
    fixed = {r.record_id: r.text for r in ocr.repair(corpus(spark, texts), labs).collect()}
    assert fixed[60] == "The tumour shows infiltrating glands and cords within a fibrous background. An ill-defined nodule is palpable in\n\nNodes examined:\n12 the left breast region."
    assert fixed[0] == CLEAN and fixed[61] is None and fixed[62] == ""
    assert noise_of(spark, []) == set() and noise_of(spark, [CLEAN], ()) == set()


def test_headings_of_no_known_name(spark):
    page = lambda k: f"Riverbank Cancer Centre, sheet {k}\nFirst line {'abc'[k] * 9}\nFINAL DIAGNOSIS:\nLast line {'def'[k] * 9}\n- {k + 1} -"
    text = "\n".join(map(page, range(3)))
    own = "\n".join(f"{CLEAN}- {k} -" for k in (1, 2)) + "\nRiverbank Cancer Centre"
    noise = noise_of(spark, [text, own], ())
    assert {(n, k) for i, n, k in noise if i == 0} >= {(1, "running_header"), (6, "running_header"), (11, "running_header"), (5, "page_number")}
    assert not any(k == "running_header" for i, _, k in noise if i == 1)


def test_no_floor_under_corpus_counts(spark):
    """A word seen twice is known as well as any; a rare real word that misreadings don't explain stays."""
    rare = "Signs of zygomatic spread were not seen. "
    real = "A moId was used. "  # 60 times: too often for misreadings of a word seen 2,000 times, as estimated
    texts = [CLEAN] * 40 + [rare, rare, rare + "zygo-\nmatic spread"] + ["The mold was used. " * 40] * 50 + [real] * 60 + ["The little tall wall fell well until all still fell. " * 40] * 150
    noise = noise_of(spark, texts)
    assert noise == {(42, 1, "broken_word")}


def test_probabilities_are_estimated_and_bounded(spark):
    line = "The tumour shows infiltrating glands and cords within a fibrous background. " * 5 + "\n"
    seen = line.replace("glands", "g1ands", 1)
    corpus_of = ocr.Corpus(corpus(spark, [line] * 300 + [seen] * 9))
    assert corpus_of.chances["1>l"] == pytest.approx((9 + 1) / (sum((line * 300 + seen * 9).count(c) for c in "l") + 1000), rel=0.01)
    assert corpus_of.chances["cl>d"] < corpus_of.chances["1>l"] and len(corpus_of.chances) == sum(map(len, ocr.CONFUSIONS.values()))
    found = {r.w: r for r in corpus_of.doubtful.collect()}
    assert [o.v for o in found["g1ands"].options] == ["glands"] and found["g1ands"].share == 0.0 and "glands" not in found
    scan = ocr.Scan([], corpus_of.filter())
    assert scan.may_be_doubtful("g1ands") and not scan.may_be_doubtful("glands") and scan.may_be_doubtful("1O2")


def test_variants_both_ways_and_two_steps(spark):
    assert ocr.once_confused("ab1e", ocr.FORWARD)["able"] == "1>l" and "ab1e" in ocr.once_confused("able", ocr.BACKWARD)
    words = "The tumour shows infiltrating glands. " * 30
    found = {r.w: r.options for r in ocr.Corpus(corpus(spark, [words] * 4 + ["The tumour shows lnfiltratlng glands."])).doubtful.collect()}
    assert [o.v for o in found["lnfiltratlng"]] == ["infiltrating"]


def test_viterbi_equals_exhaustive_search():
    from itertools import product

    words = {"left": 900, "lift": 300, "the": 2000, "lung": 800, "long": 200, "of": 1500, "1eft": 3}
    pairs = {("the", "left"): 500, ("left", "lung"): 400, ("the", "lift"): 10, ("lift", "long"): 50}
    options = {"1eft": [("left", -4.0), ("lift", -5.0)], "lnng": [("lung", -5.0), ("long", -4.5)]}
    channel = ocr.Channel(words, options, {"1eft": 0.1}, pairs, 6000)

    def score(seq, seen):
        s = 0.0
        for k, (w, o) in enumerate(zip(seq, seen, strict=True)):
            s += channel._next(seq[k - 1] if k else None, w) + (dict(channel.candidates(o)).get(w, ocr.RIGHT if w == o else -1e9) if channel.candidates(o) else 0)
        return s

    for seen in (["the", "1eft", "lnng", "of"], ["1eft", "lnng"], ["of", "lnng", "1eft"]):
        every = [[w, *(c for c, _ in channel.candidates(w))] for w in seen]
        assert channel.decode(seen) == list(max(product(*every), key=lambda s: score(s, seen)))
        asked = channel.wanted_pairs(seen)
        assert asked == {(a, b) for x, y in zip(every, every[1:], strict=False) for a in x for b in y if len(x) > 1 or len(y) > 1}


def test_pattern_is_the_vocabularies_own():
    public = pytest.importorskip("public_tokenizers")
    assert PATTERN == public.PATTERN
