"""Every stage of the pipeline against a brute-force version on its own input."""

import collections
import re
import zlib

import corpus_pipeline as pipeline
import numpy as np
from visitlab.llm import toxicity
from visitlab.llm.common import materialize, table
from visitlab.llm.encode import Encoder
from visitlab.llm.queries import tokenizer_path, training_labels

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    stages = dict(pipeline.STAGES)
    kept = [docs]
    for name in ("toxicity", "near-duplicates", "decontamination", "mixing"):
        out = materialize(stages[name](spark, kept[-1], SF), name)
        assert out.columns == docs.columns
        kept.append(out)
    rows = [{r["doc_id"]: r["text"] or "" for r in k.collect()} for k in kept]

    slots, values, bias = toxicity._weights(toxicity.train(docs, training_labels(spark, SF)))
    one_by_one = {i: toxicity.score([t.encode()], slots, values, bias)[0] for i, t in rows[0].items()}
    assert set(rows[1]) == {i for i, s in one_by_one.items() if s < 0.5}

    sets = {}
    for i, t in rows[1].items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            changed |= (group[a], group[b]) != (low, low)
            group[a] = group[b] = low
    assert set(rows[2]) == {i for i in sets if group[i] == i}

    grams = {r["item_id"]: {tuple(w[k:k + 8]) for w in [words(r["text"])] for k in range(len(w) - 7)} for r in table(spark, SF, "benchmark").collect()}
    clean = set()
    for i, t in rows[2].items():
        w = words(t)
        own = {tuple(w[k:k + 8]) for k in range(len(w) - 7)}
        if not any(len(own & g) >= 0.3 * len(g) for g in grams.values()):
            clean.add(i)
    assert set(rows[3]) == clean

    copies = collections.Counter(r["doc_id"] for r in kept[4].collect())
    assert set(copies) <= clean and max(copies.values()) <= 2
    size = {i: len(t.split()) for i, t in rows[3].items()}
    assert abs(sum(size[i] * n for i, n in copies.items()) - 1.5 * sum(size.values())) < 0.1 * sum(size.values())

    enc = Encoder(tokenizer_path())
    start, want = 0, []
    for i in sorted(copies):
        ids = np.array([*(enc.whole(rows[3][i]) if rows[3][i] else []), 0], "<u4")
        for _ in range(copies[i]):
            want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    got = stages["token files"](spark, kept[4], SF).collect()
    assert sorted(tuple(r) for r in got) == want
