"""Every stage on nulls, empty and very long texts, repeated rows, an empty table and columns with clashing names."""

import collections

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from visitlab.llm.common import materialize, table

SF = "/root/testdata/sf0.001"
CLASHING = ["toxicity", "__word", "__bits", "__row", "__key", "__text", "score", "size", "rank", "component_id"]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("bcdfgklmnprst"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents of the tables, then odd rows; every clashing column holds the row's number."""
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF, "documents").where("doc_id < 40").orderBy("doc_id").collect()]
    long_text, twin = prose(1, 30_000), prose(2, 40)
    rows += [(9001, None, "a"), (9002, "", "a"), (9003, "  \n", None), (9004, long_text, "a"), (9005, prose(3, 30), None), (None, prose(4, 30), "a"),
             (None, prose(4, 30), "a"), (9006, twin, "a"), (9006, twin, "a"), (9007, twin, "b"), (9008, prose(5, 30), "b"), (9008, prose(6, 30), "b")]
    fields = ", ".join(f"{c} long" for c in CLASHING)
    return materialize(spark.createDataFrame([(*r, *[n] * len(CLASHING)) for n, r in enumerate(rows)], f"doc_id long, text string, source string, {fields}"), "odd")


def odd_rows(df):
    assert all(r["toxicity"] == r["__bits"] == r["component_id"] == r["__row"] for r in df.select("toxicity", "__bits", "component_id", "__row").collect())
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is None or r["doc_id"] > 9000)


def test_stages_on_odd_rows(spark, odd):
    stages = dict(pipeline.STAGES)
    given = odd_rows(odd)
    calm = materialize(stages["toxicity"](spark, odd, SF), "calm")
    # the model of these few labels takes the very long text for toxic: known, see README
    short = {k: n for k, n in given.items() if k[0] != 9004}
    assert calm.columns == odd.columns and {k: n for k, n in odd_rows(calm).items() if k[0] != 9004} == short

    single = materialize(stages["near-duplicates"](spark, odd, SF), "single")
    assert single.columns == odd.columns
    want = given.copy()
    want[9006, prose(2, 40)] = 1
    del want[9007, prose(2, 40)]
    assert odd_rows(single) == want

    clean = materialize(stages["decontamination"](spark, single, SF), "clean")
    assert clean.columns == odd.columns and odd_rows(clean) == want

    mixed = materialize(stages["mixing"](spark, clean, SF), "mixed")
    assert mixed.columns == odd.columns
    drawn = odd_rows(mixed)
    assert set(drawn) <= set(want) and all(n <= 2 * want[k] for k, n in drawn.items())

    files = stages["token files"](spark, clean, SF).collect()
    assert len(files) == clean.count()
    counts = {r["doc_id"]: r["n_tokens"] for r in files}
    assert counts[9001] == counts[9002] == 1 and counts[9004] > 30_000
    assert sum(r["doc_id"] is None for r in files) == 2
    starts = sorted((r["start"], r["n_tokens"]) for r in files)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_stages_of_an_empty_table(spark, odd, name):
    empty = materialize(odd.where(F.lit(False)), "empty")
    out = dict(pipeline.STAGES)[name](spark, empty, SF)
    assert out.count() == 0
    if name != "token files":
        assert out.columns == odd.columns
