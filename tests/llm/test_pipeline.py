import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as cp  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_catch_planted_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.collect()
    clean = max(base, key=lambda r: len(set(r.text.split())))
    own = [r.text.split() for r in base if r.lang == clean.lang and len(r.text.split()) > 250][:3]
    passage, first, other = (" ".join(w[::-1][:n]) for w, n in zip(own, (70, 120, 120)))
    planted = [
        (900001, None, "en", "x", 0), (900002, "", "en", "x", 0), (900003, "123 456 !!", "en", "x", 10),
        (900004, clean.text, clean.lang, "x", len(clean.text)), (900005, first + " " + passage + " end here", "en", "x", 1), (900006, f"Other {other} two. " + passage + " last", "en", "x", 1),
    ]
    df = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    got = {}
    cur = df
    for name, f in cp.STAGES[:-1]:
        cur = cp.materialise(f(spark, cur, SF), name)
        assert cur.columns == docs.columns
        got[name] = {r.doc_id: r.text for r in cur.collect()}
    assert not {900001, 900002, 900003} & got["language"].keys() and clean.doc_id in got["language"]
    assert len(got["language"]) >= len(base) * 0.98
    assert 900004 in got["toxicity"] or clean.doc_id not in got["toxicity"]
    assert 900004 not in got["near_duplicates"]
    two = df.filter("doc_id IN (900005, 900006)")  # the stage is judged on its own input
    left = {r.doc_id: r.text for r in cp.repeats(spark, two, SF).collect()}
    assert passage in left[900005] and passage not in left.get(900006, "")
    last = cp.STAGES[-1][1](spark, cur, SF).collect()
    assert {r.doc_id for r in last} == got["repeats"].keys()


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        docs = cp.materialise(f(spark, docs, SF), "e")
        assert docs.count() == 0


def test_rows_go_through_the_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.collect()
    clean = max(base, key=lambda r: len(set(r.text.split())))
    own = [r.text.split() for r in base if r.lang == clean.lang and len(r.text.split()) > 250][:3]
    passage, first, other = (" ".join(w[::-1][:n]) for w, n in zip(own, (70, 120, 120)))
    planted = [(900005, first + " " + passage + " end here", "en", "x", 1), (900006, f"Other {other} two. " + passage + " last", "en", "x", 1)]
    cur = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    got = {}
    for name, f in cp.STAGES[:-1]:
        cur = cp.materialise(f(spark, cur, SF), name)
        got[name] = {r.doc_id: r.text for r in cur.collect()}
    assert got["repeats"][900006] == f"Other {other} two. last" and passage in got["repeats"][900005]
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in got["language"]}
    clean_ids, toxic_ids = ({k for k, v in label.items() if v == y} for y in (0, 1))
    assert len(clean_ids) > 50 and len(toxic_ids) > 5
    assert len(clean_ids & got["toxicity"].keys()) >= 0.95 * len(clean_ids)
    # three of the 11 labelled 1 hold no insult that another of them holds
    assert toxic_ids & got["toxicity"].keys() <= {151, 164, 179}
    assert len(got["toxicity"]) >= 0.8 * len(got["language"])
    assert len(got["near_duplicates"]) >= 0.7 * len(got["toxicity"]) and len(got["repeats"]) >= 0.9 * len(got["near_duplicates"])
    assert clean.doc_id in got["repeats"]
