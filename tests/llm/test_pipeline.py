"""The pipeline's stages, each against a brute-force version on its own input."""

import re

import numpy as np
import pytest

import corpus_pipeline as P
from orrery.llm import decontaminate, toxicity
from orrery.llm.common import materialize
from test_operators import SF, odd, plain_components  # noqa: F401


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["drop_toxic", "remove_boilerplate", "drop_near_duplicates", "drop_leaks", "mix_sources"]
    assert P.ORACLE_SQL is None


@pytest.fixture(scope="module")
def run(spark):
    """(input, output) rows of every stage on the small tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        after = materialize(stage(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def pairs(run, name):
    before, after = run[name]
    return {r["doc_id"]: r for r in before.collect()}, {r["doc_id"]: r for r in after.collect()}


def test_columns_stay(run):
    for name in list(run)[:-1]:
        assert run[name][1].columns == run[name][0].columns


def test_toxic_stage(spark, run):
    before, after = pairs(run, "drop_toxic")
    model = toxicity.train(run["drop_toxic"][0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = set()
    for i, r in before.items():
        w = toxicity.text_words(r["text"])
        x = np.zeros(len(model.weights))
        for word in w:
            for c in toxicity.Features().of_word(word):
                x[c] += 1 / np.sqrt(len(w))
        if sum(1 / (1 + np.exp(-(x @ model.weights - b))) for b in model.thresholds) < toxicity.REJECT_AT:
            want.add(i)
    assert set(after) == want


def test_boilerplate_stage(run):
    before, after = pairs(run, "remove_boilerplate")
    strip = lambda x: x.strip(" \t\n\x0b\x0c\r")
    sites = {}
    for r in before.values():
        for x in r["text"].split("\n"):
            sites.setdefault(strip(x), set()).add(r["source"])
    spread, framed, frames = {}, {}, {}
    for i, r in before.items():
        lines = r["text"].split("\n")
        spread[i] = [bool(strip(x)) and len(sites[strip(x)]) >= 6 for x in lines]
        framed[i] = 2 * sum(len(x) for x, s in zip(lines, spread[i]) if s) <= sum(map(len, lines))
        for x, s in zip(lines, spread[i]):
            if s and framed[i]:
                frames.setdefault(strip(x), set()).add(r["text"])
    for i, r in before.items():
        keep = [x for x, s in zip(r["text"].split("\n"), spread[i]) if not (s and (framed[i] or len(frames.get(strip(x), ())) >= 6))]
        assert after[i]["text"] == "\n".join(keep)


def test_near_duplicate_stage(run):
    before, after = pairs(run, "drop_near_duplicates")
    ids = sorted(before)
    want, _ = plain_components([before[i]["text"] for i in ids], 5, 80)
    assert set(after) == {i for k, i in enumerate(ids) if want[k] == k}


def test_leak_stage(spark, run):
    before, after = pairs(run, "drop_leaks")
    items = [decontaminate.item_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    code = {}
    number = lambda words: np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    items = [number(x) for x in items]
    want = {i for i, r in before.items() if any(
        decontaminate.edit_distance(x, number(decontaminate.item_words(r["text"]))) <= decontaminate.max_edits(len(x)) for x in items)}
    assert set(before) - set(after) == want


def test_mix_stage_covers_what_is_left(run):
    before, after = pairs(run, "mix_sources")
    assert set(before) == set(after)
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", before[i]["text"])) for i, r in after.items())


def test_stages_on_odd_rows(spark, odd):  # noqa: F811
    docs = odd
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "mix_sources":
            assert out.columns == odd.columns
            docs = materialize(out, name)
        n = out.count()
    # one row of the repeated one and of its copy are gone
    assert n == 9
