from collections import Counter

import pytest
from pyspark.sql import functions as F

from marrow.llm import canon, quota, stable_sample

TERMS = [
    ("A1", "site", "left breast, upper outer quadrant", []), ("A2", "site", "left breast", ["breast, left"]), ("A3", "site", "right breast", []),
    ("A4", "site", "right upper lobe lung", []), ("A5", "site", "right lower lobe lung", []), ("A6", "site", "left lower lobe lung", []), ("A7", "site", "nipple and areola", None),
    ("G1", "tumor_grade", "Grade 1", ["G1", "well differentiated"]), ("G2", "tumor_grade", "Grade 2", ["G2", "moderately differentiated"]), ("G3", "tumor_grade", "Grade 2-3", []),
    ("GX", "tumor_grade", "GX", []),
]
CASES = [
    ("site", "LEFT BREAST", "A2"), ("site", " left breast", "A2"), ("site", "left breast UOQ", "A1"), ("site", "L breast uoq", "A1"), ("site", "rt brst", "A3"), ("site", "RUL", "A4"),
    ("site", "LLL", "A6"), ("site", "lung RLL", "A5"), ("site", "left-lower-lobe-lung", "A6"), ("site", "leftlowerlobelung", "A6"), ("site", "left uppr breast outer quadrant", "A1"),
    ("site", "ca. of right breast (see diagram)", "A3"), ("site", "areola, nipple and", "A7"), ("site", "lobe lung lower", "none"), ("site", "right ovary", "none"), ("site", "unknown", "none"),
    ("site", "?", "none"), ("site", "x" * 20_000, "none"), ("tumor_grade", "gr. II", "G2"), ("tumor_grade", "G2/G3", "G3"), ("tumor_grade", "between grade 2 and 3", "G3"),
    ("tumor_grade", "grade 2 (of 3)", "G2"), ("tumor_grade", "mod. diff", "G2"), ("tumor_grade", "Grade X", "GX"), ("tumor_grade", "ungradable", "GX"), ("tumor_grade", "stage II", "none"),
    ("tumor_grade", "Gleason 7", "none"), ("tumor_grade", "wel differentiated", "G1"),
]


def test_canonical_mapping(spark):
    terms = spark.createDataFrame(TERMS, "term_id string, field_name string, term string, synonyms array<string>")
    rows = [(i, v if f == "site" else None, v if f == "tumor_grade" else None, "x", "y") for i, (f, v, _) in enumerate(CASES)]
    rows += [(900, "left breast", None, "x", "y"), (901, None, "G1", "x", "y"), (902, "  ", "", "x", "y"), (903, None, None, "x", "y"), (904, "RUL", "gr. II", "x", "y"), (905, "RUL", None, "x", "y")]
    df = spark.createDataFrame(rows, "extraction_id long, site string, tumor_grade string, value string, field_name string")
    known = {"also": {"GX": ["ungradable"]}, "short": {"l": "left", "rt": "right"}}
    got = Counter((r.extraction_id, r.field_name, r.term_id) for r in canon.map_values(df, terms, "extraction_id", ["site", "tumor_grade"], **known).collect())
    want = {(i, f, t) for i, (f, _, t) in enumerate(CASES)} | {(904, "site", "A4"), (904, "tumor_grade", "G2"), (905, "site", "A4")}
    assert set(got) == want and set(got.values()) == {1}
    assert canon.map_values(df.limit(0), terms, "extraction_id", ["site"]).count() == 0
    assert {r.term_id for r in canon.map_values(df, terms.limit(0), "extraction_id", ["site"]).collect()} == {"none"}


def test_remarks_and_abbreviations_are_learnt(spark):
    terms = spark.createDataFrame([(f"P{i}", "site", t, None) for i, t in enumerate(["left kidney", "right kidney", "left ureter", "right ureter", "bladder", "left renal pelvis"])], "term_id string, field_name string, term string, synonyms array<string>")
    taught = [f"{t} ask ward" for t in ("left kidney", "right ureter", "bladder")] + ["xt kidney", "lx kidney", "lx ureter", "lx renal pelvis", "left kidney askward", "bladder askward", "left ureter askward"]
    asked = {"left kidny ask ward": "P0", "lx kidney": "P0", "lx uretr": "P2", "xt kidney": "none", "left kidney beside gut": "P0", "gut ask ward": "none", "leftkidneyaskward": "P0", "blader askward": "P4"}
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*taught, *asked])], "id long, site string")
    got = {r.value: r.term_id for r in canon.map_values(df, terms, "id", ["site"]).collect()}
    assert {v: got[v] for v in asked} == asked


def test_index_finds_what_comparing_all_forms_finds():
    import random

    r = random.Random(6)
    stems = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(400)]
    listed = [(f"T{i}", " ".join(r.sample(stems, r.randint(1, 4)))) for i in range(1500)]
    forms = canon.Forms(listed, False)
    mapper = canon.Mapper(forms, {}, set(), {})
    for term, form in r.sample(listed, 120):
        tokens = form.split()
        k = r.randrange(len(tokens))
        at = r.randrange(1, len(tokens[k]) - 1)
        tokens[k] = tokens[k][:at] + r.choice(["", "x", tokens[k][at + 1] + tokens[k][at]]) + tokens[k][at + 1 :]
        if r.random() < 0.3:
            tokens.reverse()
        best = max(forms.similarity(tokens, i) for i in range(len(forms.keys)))
        found = max((forms.similarity(tokens, i) for i in forms.candidates(tokens)), default=0.0)
        assert found == best or best < canon.ACCEPT
        assert len(forms.candidates(tokens)) < 200
        assert mapper.map(" ".join(tokens)) in (term, forms.terms[tuple(form.split())], "none") or best >= canon.ACCEPT


def test_edits_and_likeness():
    assert [canon.edits(a, b, 3) for a, b in (("ab", "ba"), ("abc", "abc"), ("abc", "xyzw"), ("", "ab"), ("xabz", "xbaz"), ("abcdef", "abcf"))] == [1, 0, 4, 2, 1, 2]
    assert canon.likeness("brst", "breast") and canon.likeness("mast", "mastectomy") and not canon.likeness("colectomy", "lobectomy") and not canon.likeness("2", "3")


REPORTS = "record_id long, report_id string, cancer_type string, style string, load_no int, key string, g string, n long"


def reports(spark, n=4000):
    kinds = [("BRCA", "synoptic"), ("brca ", " Mixed"), ("LUAD", None), ("LUAD", "mixed"), ("MESO", "  ")]
    rows = [(i, f"r{i}", *kinds[0 if i % 3 == 0 else i % 5 if i % 50 else 4], i % 10, "k", "g", 1) for i in range(n)]
    return spark.createDataFrame(rows + rows[:100] + [(n, None, "BRCA", "mixed", 1, "k", "g", 1), (n + 1, "zz", None, "mixed", 1, "k", "g", 1)], REPORTS)


TARGETS = "request_id int, sample_size long, cancer_type string, style string, target_share double, min_rows long"


def test_shares_floors_and_unmet_cells(spark):
    df = reports(spark).withColumn("record_id", F.monotonically_increasing_id())
    targets = spark.createDataFrame(
        [(1, 500, "BRCA", "synoptic", 0.7, 5), (1, 500, "brca", "mixed", 0.2, 5), (1, 500, "LUAD", "unknown", 0.09, 5), (1, 500, "THYM", "mixed", 0.01, 3), (2, 100, "BRCA", "any", 0.98, 0), (2, 100, "LUAD", "any", 0.02, 10), (3, 50_000, "MESO", "any", 1.0, 1)],
        TARGETS,
    )
    report = quota.checked(df, targets).collect()
    assert len(report) == 7 and all(r.floor_met and r.share_met and r.size_met and r.no_repeats for r in report)
    unmet = {(r.request_id, r.cancer_type, r.style) for r in quota.unmet(df, targets).collect()}
    assert unmet == {(1, "THYM", "mixed"), (3, "MESO", "any")}
    rows = quota.sample(df, targets).collect()
    assert max(Counter((r.request_id, r.report_id) for r in rows).values()) == 1
    n = Counter((r.request_id, r.cancer_type, r.style) for r in rows)
    # the share of the empty cell goes to the others, in proportion
    assert sum(v for k, v in n.items() if k[0] == 1) in (499, 500, 501) and abs(n[1, "BRCA", "synoptic"] - 353.5) < 2 and abs(n[1, "brca", "mixed"] - 101) < 2
    assert n[2, "LUAD", "any"] == 10 and n[2, "BRCA", "any"] == 90
    available = df.where("cancer_type = 'MESO'").select("report_id").distinct().count()
    assert n[3, "MESO", "any"] == available
    again = {(r.request_id, r.report_id) for r in quota.sample(df.repartition(9), targets).collect()}
    assert again == {(r.request_id, r.report_id) for r in rows} != {(r.request_id, r.report_id) for r in quota.sample(df, targets, seed="other").collect()}


def test_quota_edges(spark):
    targets = spark.createDataFrame([(1, 10, "BRCA", "mixed", 1.0, 2)], TARGETS)
    none = reports(spark).limit(0)
    assert quota.unmet(none, targets).count() == 1 and quota.sample(none, targets).count() == 0
    assert quota.sample(reports(spark, 50), targets.limit(0)).count() == 0
    assert quota.allocate([{"sample_size": 10, "target_share": 0.5, "min_rows": 8, "available": 100}, {"sample_size": 10, "target_share": 0.5, "min_rows": None, "available": 3}]) == pytest.approx([8, 2])


def members(df, **kw):
    return {r.report_id for r in stable_sample.select(df, "report_id", "load_no", **kw).select("report_id").collect()}


def test_sample_is_stable_as_loads_are_added(spark):
    df = reports(spark)
    kept: set = set()
    for load in (0, 3, 6, 9):
        now = members(df.where(F.col("load_no") <= load).repartition(load + 2))
        assert kept <= now
        kept = now
    assert kept == members(df) and 300 < len(kept) < 900 and None not in kept
    assert members(df, seed="other") != kept and members(df.limit(0)) == set() and members(df, rates={0: 1.0}) >= {"zz"} and members(df, rates={0: 0.0}) == set()


def test_state_on_disk_keeps_epochs_and_rates(spark, tmp_path):
    df, path = reports(spark), str(tmp_path / "state")
    state = lambda: {r.key: (r.first_epoch, r.rate) for r in stable_sample.read_state(spark, path).collect()}
    assert state() == {}
    before = members(df.where("load_no = 3 or load_no = 4"), rates={0: 0.3}, path=path)
    first = state()
    assert before and set(first.values()) == {(3, 0.3), (4, 0.3)}
    # another rate, and rows of older loads that come in late: known identifiers keep theirs, epoch 3 keeps its rate
    late = df.unionByName(df.where("load_no = 4").withColumn("load_no", F.lit(1))).unionByName(df.limit(1).withColumns({"report_id": F.lit("new"), "load_no": F.lit(3)}))
    after = members(late, rates={0: 0.01}, path=path)
    now = state()
    assert before <= after and {k: now[k] for k in first} == first and now["new"] == (3, 0.3)
    assert {v for k, v in now.items() if k not in first and k != "new"} == {(e, 0.01) for e in (0, 1, 2, 5, 6, 7, 8, 9)}
    assert members(late, rates={0: 1.0}, path=path) == after and state() == now
    # a part that was not completed does not count
    (tmp_path / "state" / "00000001" / "_SUCCESS").unlink()
    assert set(state()) == set(first)


def test_generator_gives_the_published_words(spark):
    known = [((0, 0), (0, 0), (0x6B200159, 0x99BA4EFE)), ((0xFFFFFFFF, 0xFFFFFFFF), (0xFFFFFFFF, 0xFFFFFFFF), (0x1CB996FC, 0xBB002BE7)), ((0x13198A2E, 0x03707344), (0x243F6A88, 0x85A308D3), (0xC4923A9C, 0x483DF7A0))]
    for (k0, k1), (c0, c1), want in known:
        r = spark.range(1).select(stable_sample.threefry(F.lit(k0).cast("bigint"), F.lit(k1).cast("bigint"), c0, c1).alias("x")).first().x
        assert tuple(r) == want


def test_all_rows_of_an_identifier_share_its_fate(spark):
    df = reports(spark)
    chosen = stable_sample.select(df, "report_id", "load_no")
    ids = chosen.select("report_id").distinct()
    assert df.join(ids, "report_id", "left_semi").count() == chosen.count() and chosen.columns == df.columns
