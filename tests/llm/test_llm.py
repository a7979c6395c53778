"""Operators of the training-data subpackage against brute force on small
fixtures, with nulls, empty and long texts, repeated rows, empty tables and
clashing column names."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from visitlab.llm import chat, decontaminate, mixing, neardup, pii, sharding, tokencounts, tokenfiles, tokens, topk, toxicity
from visitlab.llm.common import configure, scratch_path
from visitlab.llm.components import _least_of_each as least_of_each
from visitlab.llm.components import components
from visitlab.llm.encode import Encoder
from visitlab.llm.queries import tokenizer_path

WORDS = "the cat sat on a mat and saw birds fly over green hills while seven old men sang loud songs".split()


@pytest.fixture(autouse=True)
def _conf(spark, tmp_path):
    configure(spark)


def text(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 50, n)))


def docs(spark, rows):
    """Rows (doc_id, text, source) with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, score string, id int")


LONG = text(1, 20_000)
ROWS = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, "b"), (5, "one two", "b"), (6, "One  two", None),
        (7, text(2, 60), "a"), (8, text(2, 60) + " extra", "a"), (9, text(2, 60).upper(), "c"), (10, text(3, 60), "c"), (7, text(2, 60), "a"),
        (None, text(2, 60), "a"), (None, None, "a"), (11, "x" * 50_000, "b")]


def brute_sets(rows):
    out = {}
    for i, t, _ in rows:
        if i is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def test_near_duplicates_equal_brute_force(spark):
    base = text(9, 80).split()
    near = [(100 + k, " ".join([*base[:k], f"new{k}", *base[k + 1:]]), "n") for k in range(40)]
    edge = [(200, " ".join(base[:40]), "n"), (201, " ".join(base[:31]), "n")]
    rows = ROWS + near + edge
    got = neardup.near_duplicates(docs(spark, rows)).collect()
    sets = brute_sets(rows)
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None) == [
        (i, len(sets[i]), root(i), root(i) == i) for i in ids]
    nameless = [r for r in got if r["doc_id"] is None]
    assert len(nameless) == 2 and all(r["component_id"] is None and r["kept"] for r in nameless)
    kept = neardup.keep_one_of_each(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "source", "score", "id"]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [i for i in ids if root(i) == i]
    assert neardup.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_texts_of_one_id_are_documents_of_their_own(spark):
    rows = [(1, text(31, 60), "a"), (5, text(32, 60), "a"), (5, text(33, 60), "b"), (5, text(33, 60), "b"), (5, text(31, 60) + " tail", "a"),
            (7, text(33, 60) + " tail", "a"), (8, text(34, 60), "a"), (9, None, "a"), (9, "", "a"), (9, text(34, 60), "a"), (None, text(33, 60), "a")]
    kept = neardup.keep_one_of_each(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "source", "score", "id"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted(
        [(1, text(31, 60)), (5, text(32, 60)), (5, text(33, 60)), (8, text(34, 60)), (9, ""), (0, text(33, 60))])


def test_pairs_that_the_star_leaves_out_are_compared(spark):
    # many unlike documents share a long passage; two of them are alike
    passage = text(50, 60)
    rows = [(i, passage + " " + text(1000 + i, 25 + i % 7), "s") for i in range(60)]
    rows += [(60, rows[59][1] + " tail", "s")]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(spark, rows)).collect()}
    sets = brute_sets(rows)
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert (59, 60) in links
    assert all(got[a] == got[b] for a, b in links)
    assert all(got[i] == i for i in sets if not any(i == b for _, b in links))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(7, 7), (100, 90), (90, 100)], "a long, b long")
    assert {r["id"]: r["component"] for r in components(links).collect()} == {**{k: 0 for k in range(1, 41)}, 100: 90}


def test_a_hub_is_dealt_over_parts(spark):
    hub = [(1000, k) for k in range(1001, 1400)] + [(3, 1200), (3, 2), (1399, 5000)] + [(k, 7000) for k in range(6900, 7000)]
    links = spark.createDataFrame(hub, "a long, b long")
    want = {k: 2 for k in [3, 1000, *range(1001, 1400), 5000]} | {k: 6900 for k in range(6901, 7001)}
    assert {r["id"]: r["component"] for r in components(links).collect()} == want
    near = least_of_each(links.select(F.col("b").alias("u"), F.col("a").alias("v")).union(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    assert {r["m"] for r in near.where("u = 7000").collect()} == {6900} and near.where("u = 1000").count() == 399
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(u#" not in re.sub(r"hashpartitioning\(u#\d+L, part#\d+L", "", plan.split("SortMergeJoin")[0])


def test_words_and_hashes():
    w = tokens.space_words([b"Ab c\x0bAB", b"", b"ab " + b"z" * 300])
    assert w.doc.tolist() == [0, 0, 0, 2, 2]
    assert w.hash[0] == w.hash[2] == w.hash[3] != w.hash[1]
    a, _ = tokens.alnum_words(["École éCOLE 3.5, x".encode()])
    assert len(a.hash) == 4 and a.hash[0] == a.hash[1]


def test_encoder_equals_the_library():
    enc = Encoder(tokenizer_path())
    odd = ["a <|endoftext|> b", "x　y \x1c z", "  two  spaces\n\n end ", "'s't 'll I'll don't", "café ÉCOLE 1½ ²ªº", "emoji 😀", "\t\t x", "", "a" * 3000]
    for t in [*odd, LONG, *odd]:
        assert enc.ids(t).tolist() == enc.whole(t).tolist()


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_IDS", 100)
    path = scratch_path(spark, "t")
    d = docs(spark, ROWS)
    tokenfiles.write(d, path, tokenizer_path())
    enc = Encoder(tokenizer_path())
    order = sorted(((i is not None, i or 0, t or "") for i, t, _ in ROWS))
    want, start = collections.Counter(), 0
    starts = {}
    for named, i, t in order:
        ids = np.array([*enc.whole(t), 0], "<u4") if t else np.array([0], "<u4")
        key = (i if named else None, len(ids), zlib.crc32(ids.tobytes()))
        want[key] += 1
        if named:
            starts.setdefault(i, start)
        start += len(ids)
    got = tokenfiles.read_back(d, path).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert all(min(r["start"] for r in got if r["doc_id"] == i) == s for i, s in starts.items())
    assert tokenfiles.read_one(spark, path, 5).tolist() == [*enc.whole("one two"), 0]
    assert tokenfiles.read_one(spark, path, 12345) is None
    empty = scratch_path(spark, "t")
    tokenfiles.write(d.limit(0), empty, tokenizer_path())
    assert tokenfiles.read_back(d.limit(0), empty).count() == 0


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(-2**62, 2**62, 5000))
    sizes, bits, rest = tokenfiles.build_hash(keys)
    assert sorted(tokenfiles.evaluate(keys, sizes, bits, rest)) == list(range(len(keys)))
    assert len(bits) < 4 * len(keys)


def test_token_counts(spark):
    enc = Encoder(tokenizer_path())
    lens = np.array([len(enc.whole(t)) if t else 0 for _, t, _ in ROWS])
    hist = tokencounts.histogram(docs(spark, ROWS), tokenizer_path())
    for r in hist.collect():
        n = r["n_tokens"]
        assert (r["n_docs"], r["docs_ge"], r["tokens_ge"], r["truncated_total"]) == (
            (lens == n).sum(), (lens >= n).sum(), lens[lens >= n].sum(), np.minimum(lens, n).sum())
    rep = tokencounts.report(hist, [10, 1000], [0.5, 1.0]).first()
    assert (rep["tokens"], rep["total_10"], rep["total_1000"]) == (lens.sum(), np.minimum(lens, 10).sum(), np.minimum(lens, 1000).sum())
    assert rep["q_0.5"] == np.sort(lens)[len(lens) // 2 - 1] and rep["q_1.0"] == lens.max()
    empty = tokencounts.histogram(docs(spark, ROWS).limit(0), tokenizer_path())
    assert empty.count() == 0 and tokencounts.report(empty, [5], [0.5]).first().asDict() == {"docs": 0, "tokens": 0, "total_5": 0, "q_0.5": None}


def test_decontamination(spark):
    item = "John Smith has 12 apples and gives 5 apples to Mary before he walks 3 km to the shop in Paris. How many apples are left?"
    bench = spark.createDataFrame([(1, item, 0), (2, "short one here", 0), (3, None, 0), (None, item, 0)], "item_id long, text string, doc_id int")
    changed = "Anna Jones has 40 apples and gives 7 apples to Peter before he walks 9 km to the shop in London. How many apples are left?"
    clash = "John Smith has 12 apples and gives 12 apples to Mary before he walks 12 km to the shop in Paris. How many apples are left?"
    rows = [(1, LONG + ". " + item + " " + text(4, 50), "a"), (2, changed, "a"), (3, clash, "a"), (4, "a SHORT one, here!", "a"),
            (5, text(5, 300), "a"), (6, None, "a"), (7, "", "a"), (1, item.upper(), "a")]
    d = docs(spark, rows)
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_windows"], r["n_changed"]) for r in decontaminate.contaminated(d, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2)}
    assert got[1, 1][2] == 0 and got[2, 1][2] == 6 and got[4, 2] == (1, 1, 0)
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(d, bench).collect()) == [3, 5, 6, 7]
    assert decontaminate.contaminated(d, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(d.limit(0), bench).count() == 0


def found(item: str, *texts: str) -> list[bool]:
    """Whether each text is contaminated by the item."""
    bench = decontaminate.item_windows([(1, item)])
    hit = {m[0] for m in decontaminate.matches([t.encode() for t in texts], bench)}
    return [k in hit for k in range(len(texts))]


def test_decontamination_leaves_out_clashing_windows_only():
    lead = "the farmer counts 12 boxes in the old barn and then loads them on a cart that goes to the market near the river where "
    item = lead + "a trader buys 12 boxes and sells half of them to a shop that is open until late in the evening while it rains hard outside"
    assert found(item, item.replace("buys 12", "buys 40"), item.replace("12", "31"), item.replace("trader", "broker")) == [True] * 3
    asked = "the farmer John has 12 boxes and gives 5 of them to the shop before noon so how many are there now"
    assert found(asked, asked.replace("12", "7").replace(" 5", " 7")) == [True]  # two slots with the same value
    many = "take 3 of 4 and 5 of 6 and 7 of 8 and 9 of 10 and 11 of 12 and 13 of 14"
    assert found(many, "take " + " and ".join(["0 of 0"] * 6), many.replace("3", "30")) == [False, True]


def test_decontamination_takes_sentence_openers_as_names():
    item = "Tom has 3 apples. Tom buys 4 pears. Tom eats 2."
    assert found(item, "Ann has 7 apples. Ann buys 9 pears. Ann eats 5.", "Ann has 7 apples. Bob buys 9 pears. Eve eats 5.",
                 "x: Ann has 7 apples. Ann buys 9 pears. Ann eats 5. Then she goes.", "Tom sees 3 apples. Tom takes 4 pears. Tom drops 2.") == [True, False, True, False]
    long = "Maria walks 4 km to school. Maria rests at the old bridge. Maria meets 2 friends there. How far does Maria walk in 5 days?"
    assert found(long, long.replace("Maria", "Peter").replace("4", "6"), long.replace("Maria", "She")) == [True, True]


def test_decontamination_counts_a_run_of_a_long_item():
    words = text(6, 400).split()
    part = lambda a, n: f"so {' '.join(words[a:a + n])} end"
    assert found(" ".join(words), part(100, 80), part(0, 13), part(387, 13), part(200, 12)) == [True, True, True, False]
    assert found(" ".join(words[:59]), part(10, 21), part(10, 9) + " " + part(30, 9)) == [True, False]


def test_decontamination_filter_needs_no_item_id(spark):
    bench = spark.createDataFrame([(None, text(8, 40)), (1, "short one here")], "item_id long, text string")
    rows = [(1, text(8, 40), "a"), (2, text(9, 40), "a"), (None, text(8, 40), "a")]
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs(spark, rows), bench).collect()] == [2]


def test_toxicity_learns_and_handles_edge_cases(spark):
    rows = [(i, text(i, 80) + (" idiot scum" if i % 4 == 0 else ""), "a") for i in range(400)] + [(1000, None, "a"), (1001, "", "a")]
    d = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(1000, None)], "doc_id long, toxic int")
    scored = toxicity.score_table(d, toxicity.train(d, labels))
    assert scored.columns == ["doc_id", "text", "source", "id", "score"]
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    assert got[1000] == got[1001] and 0 < got[1000] < 0.5
    none = toxicity.train(d, labels.limit(0))
    assert {r["score"] for r in toxicity.score_table(d, none).collect()} == {0.5}
    assert toxicity.score_table(d.limit(0), none).count() == 0


def test_mixing_targets_and_determinism(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [(k, text(k, 5 + k % 40), "abc"[k % 3] if k % 7 else None) for k in range(300)] + [(900, None, "a"), (901, "", "zero"), (902, "", "zero")]
    d = docs(spark, rows)
    got = mixing.mix_counts(d).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for i, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        level = rest / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * level > 2 * size[s]}
        if not over:
            break
        full |= over
    target = {s: 2 * size[s] if s in full else weight[s] * level for s in order}
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6 and r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 25 for s in order)
    again = mixing.mix_counts(d.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    copies = collections.Counter(r["doc_id"] for r in mixing.mixture(d).collect())
    assert copies == collections.Counter({r["doc_id"]: r["n_copies"] for r in got if r["n_copies"]})
    assert mixing.mix_counts(d.limit(0)).count() == 0 and mixing.mixture(d.limit(0)).count() == 0


def test_splitting_tree_keeps_the_quotas(spark):
    quotas = spark.createDataFrame([(0, 700), (1, 50), (2, 3)], "rank long, quota long")
    leaf = mixing.splitting_tree(quotas, 300).collect()
    for rank, n in ((0, 700), (1, 50), (2, 3)):
        of = sorted((r["begin"], r["n"]) for r in leaf if r["rank"] == rank)
        assert sum(x for _, x in of) == n and [b for b, _ in of] == list(np.cumsum([0] + [x for _, x in of[:-1]]))
    per = collections.Counter()
    for r in leaf:
        per[r["shard"]] += r["n"]
    assert set(per.values()) <= {1, 2, 3, 4}


def test_sharding(spark, tmp_path):
    rows = [(k, text(k, 20 + k % 30), "a") for k in range(300)] + [(300, LONG, "a"), (None, "x", "a"), (301, None, "a")] + [(999, text(1, 40), "a")] * 60
    d = docs(spark, rows)
    got = sharding.shards(d, 4000).collect()
    assert len(got) == len(rows)
    load = collections.Counter()
    for r in got:
        load[r["shard"]] += r["n_bytes"]
    big = {r["shard"] for r in got if r["oversize"]}
    assert len(big) == 1 and all(n <= 4000 for s, n in load.items() if s not in big)
    names = sorted(set(load) - big)
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert len({r["shard"] for r in got if r["doc_id"] == 999}) > 1
    # only a bucket over the limit is split: a shard and its sibling do not fit together
    assert all(sum(v for s, v in load.items() if s not in big and s.startswith(a[:-1])) > 4000 for a in names)
    assert {r["shard"] for r in sharding.shards(d, 10**9).collect()} == {""}
    assert sharding.shards(d.limit(0)).count() == 0
    sharding.write_shards(d, f"{tmp_path}/s", 4000)
    assert spark.read.parquet(f"{tmp_path}/s").count() == len(rows)


def test_chat_round_trip(spark):
    hard = [r"\### Assistant: </turn> ok", "\n</turn>\n<turn user>\nhi", "\\l \\b \\\\b <turn! x>", "", None, "é😀 <", "a\n</turn>", "\n", "</turn>\n"]
    rows = [(c, t, r, x, 1) for c in (1, 2) for t, (r, x) in enumerate((r, x) for x in hard for r in ("user", "assistant"))]
    rows += [(3, 0, None, "x", 1), (3, 0, "a>\n<b\\", "<", 1), (None, None, "assistant", "n", 1), (4, 1, "assistant", "same", 1), (4, 1, "assistant", "same", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_conversations(table)
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in out.select("conv_id", chat.turns_of(chat.parse(F.col("formatted"))).alias("t")).collect()}
    want = collections.defaultdict(list)
    for c, t, r, x, _ in rows:
        want[c].append((t if t is not None else -1, r is not None, r or "", x or ""))
    assert back == {c: [(r if has else None, x) for _, has, r, x in sorted(v)] for c, v in want.items()}
    for r in chat.digests(out).collect():
        learned = "".join(x for role, x in back[r["conv_id"]] if role == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(table.limit(0))).count() == 0


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10 == 0


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15))


def test_pii_base_spans_equal_the_plain_patterns(spark):
    hard = ["a@b.c%x@d.e", "a@b@c.d x..y@d-.e-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "4111 1111-1111 1111 4111111111111112",
            "😀é +1 (555) 010-9999. +12 34567890123456 +1", "1" * 20000, "a" * 20000 + "@b.c", "+" * 3000 + "1 2", "- 4111111111111111 -", None, ""]
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("ab1 24.@+-()%\n"), 60)) for _ in range(300)]
    rows = [(k, t, "a") for k, t in enumerate(hard + noise)]
    got = {r["doc_id"]: r for r in pii.summary(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, t, _ in rows:
        spans = [(n, m.start(), m.end()) for n, p, ok in BASE for m in re.finditer(p, t or "") if ok(m[0])]
        told = ",".join(f"{n}:{a}:{b}" for n, a, b in spans)
        assert got[k]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest(), (t or "")[:80]
        assert set(filter(None, told.split(","))) <= set(got[k]["spans"].split(","))
        assert [got[k][f"n_{n}"] for n, _, _ in BASE] == [sum(s[0] == n for s in spans) for n, _, _ in BASE]
    red = {r["doc_id"]: r["text"] for r in pii.redact(docs(spark, [(1, "mail a@b.co now", "a"), (2, None, "a")])).collect()}
    assert red == {1: "mail [email] now", 2: ""}
    assert pii.summary(docs(spark, rows).limit(0)).count() == 0


def test_pii_adds_wide_formats_that_read_like_validated_ones(spark):
    rng = np.random.default_rng(7)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    base = ["{} +1 ({}) {}-{} or {} u{}@site.org".format(a, digits(3), digits(3), digits(4), b, digits(2)) for a, b in [("call", "mail"), ("ring", "ask")] * 150]
    base += [f"host 10.{k % 256}.3.{k % 200} rack 999.{k}.1.1, lot {digits(16)} of {digits(5)}, code +{digits(3)} {digits(2)}" for k in range(300)]
    wide = [f"call ({digits(3)}) {digits(3)}-{digits(4)} today" for _ in range(100)] + ["write to jane.doe [at] site [dot] org today"] * 50
    wide += ["pay 4111.1111.1111.1111 now", "pay 4111.1111.1111.1112 now", "on 2024-01-15 or 1999-2003", "rack 300.168.100.220 up", "at 10.50 for 12-13"]
    wide.append("host 2001:0db8:0000:0000:0000:ff00:0042:8329 mac 00:1a:2b:3c:4d:5e")
    rows = [(k, t, "a") for k, t in enumerate(base + wide)]
    got = {r["doc_id"]: r["spans"] for r in pii.summary(docs(spark, rows)).collect()}
    at = len(base)
    assert {got[k] for k in range(at, at + 100)} == {"phone:5:19"}
    assert {got[k] for k in range(at + 100, at + 150)} == {"email:9:37"}
    assert [got[k] for k in range(at + 150, len(rows))] == ["card:4:23", "", "", "", "", "ip:5:44"]
    assert all(s.count(":") == 4 for s in (got[k] for k in range(300)))  # nothing added inside base spans


def test_pii_adds_the_same_digits_by_their_context_alone(spark):
    rng = np.random.default_rng(17)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    rows = [f"please dial +1 ({digits(3)}) {digits(3)}-{digits(4)} soon" for _ in range(300)]
    rows += [f"batch {digits(5)} stored" if k % 5 == 0 else "batch {} stored".format("-".join([digits(5), "7", "8", digits(5)][:k % 5])) for k in range(400)]
    at = len(rows)
    same = ["5551 2345", "(212) 555-0187", "555.01.8734"]
    rows += [f"please dial {d} soon" for d in same] + [f"batch {d} stored" for d in same]
    table = docs(spark, [(k, t, "a") for k, t in enumerate(rows)])
    cands = pii.candidates(pii.proposals(table))
    weight = dict(zip(pii.FEATURES, pii.trained(cands)[0].featureImportances.toArray()))
    assert weight["odds_before"] + weight["odds_after"] > 0.5
    answers = [{r["doc_id"]: r["spans"] for r in pii.summary(t).collect()} for t in (table, table.repartition(5))]
    assert answers[0] == answers[1]
    assert [answers[0][at + k] for k in range(6)] == ["phone:12:21", "phone:12:26", "phone:12:23", "", "", ""]


def test_pii_learns_from_every_candidate(spark):
    letters = lambda k: "".join(chr(97 + k // 26 ** i % 26) for i in range(4))
    n, each = 21_000, 100
    rows = [" ".join(f"{letters(k)} u{k}@site.org." for k in range(at, at + each)) for at in range(0, n, each)]
    rows += [f"lot {1_000_000 + k} kept" for k in range(500)] + ["lot 1000007 kept"]
    cands = pii.candidates(pii.proposals(docs(spark, [(k, t, "a") for k, t in enumerate(rows)])))
    examples = pii._context(pii._examples(cands)).cache()
    # every distinct candidate, once
    assert {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()} == {1.0: n, 0.0: 500}
    model, odds, floors = pii.trained(cands)
    told = {r["word_before"] for r in examples.where("part < 2 and label = 1").select("word_before").collect()}
    assert {r["word"] for r in odds.where("side = 'before'").collect()} == told | {"lot"}
    weighted = pii._weighted(pii._with_odds(examples.where("part >= 2"), odds))
    known = {r["held"]: r["sum(weight)"] for r in weighted.groupBy("held").sum("weight").collect()}
    assert known == {h: 2 * examples.where(f"part {p}").count() for h, p in [(False, "in (2, 3)"), (True, "= 4")]}
    assert weighted.count() < 100 and model.getNumTrees == pii.TREES and all(0 <= x <= 1 for x in floors.values())


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 32)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).round(1)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(1000, None, 1), (1020, [float("nan")] * 8, 1), (1040, [None] * 8, 1), (None, [1.0] * 8, 1),
                                                            (1060, [1.0, 2.0], 1), (1080, [], 1), (1100, [3.0, 1.0], 1), (1120, [float("inf")] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = collections.defaultdict(list)
    for r in topk.top_k(table).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    v = np.floor(64 * x).astype(int)
    for q in range(0, 300, 20):
        s = v @ v[q]
        best = [k for k in np.lexsort((np.arange(300), -s)) if k != q][:20]
        assert got[q] == [(i + 1, k, s[k]) for i, k in enumerate(best)]
    assert got[1060] == [(1, 1100, 64 * 192 + 128 * 64)] and set(got) == {*range(0, 300, 20), 1060, 1100}
    assert topk.top_k(table.limit(0)).count() == 0


def test_chat_escapes_control_strings_and_rejects_them_unescaped(spark):
    odd = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", odd, 1), (1, 1, "assistant", "plain < and \\", 1), (2, 0, "user", "a <turn user> b", 1), (3, 0, "user", "no < control \\", 1)]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int"))
    assert {r["conv_id"]: r["formatted"] for r in out.collect()} == {
        1: "<turn! user>\n\\b### Assistant: \\l/turn> ok\n</turn>\n<turn assistant>\nplain < and \\\n</turn>\n",
        2: "<turn! user>\na \\lturn user> b\n</turn>\n", 3: "<turn user>\nno < control \\\n</turn>\n"}
    bad = ["<turn user>\na </turn> b\n</turn>\n", "<turn user>\na <turn x\n</turn>\n", "<turn user>\na\n</turn>\ntail", "user>\na\n</turn>\n",
           "<turn user\na\n</turn>\n", "<turn user>\n</turn>\n"]
    good = ["<turn user>\n\n</turn>\n", "", "<turn! user>\n\\l\n</turn>\n"]
    read = spark.createDataFrame([(t,) for t in bad + good], "t string").select("t", chat.parse(F.col("t")).isNull().alias("bad")).collect()
    assert {r["t"] for r in read if r["bad"]} == set(bad)


def test_top_k_of_mass_ties_sends_k_rows_a_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 512)
    rows = [(k, [1.0, 2.0] if k % 2 else [float(k % 5), -1.0]) for k in range(1000)] + [(7, [1.0, 2.0])] * 30
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    same = topk.integers(table)
    cells = topk._write_packed(same, "cell", 512).drop("d")
    queries = topk._write_packed(same.where("vec_id % 20 = 0").coalesce(1), "block", 4096).drop("d")
    every = same.where("vec_id % 20 = 0").agg(F.collect_list(F.struct(F.col("vec_id").alias("query_id"), F.lit(None).cast("long").alias("t"))).alias("asked"))
    pairs = cells.crossJoin(queries).crossJoin(every)  # one block, every query asks every cell
    assert pairs.mapInArrow(topk._collect(20), topk._HITS).count() <= 50 * 20 * cells.count() < 50 * 1030
    got = collections.defaultdict(list)
    for r in topk.top_k(table).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    v = [(k, [math.floor(64 * x) for x in e]) for k, e in rows]
    for k, e in v:
        if k % 20 == 0:
            want = sorted(((-sum(a * b for a, b in zip(e, f)), i) for i, f in v if i != k))[:20]
            assert got[k] == [(i, -s) for s, i in want]


def test_top_k_of_mixed_lengths_repeated_ids_and_large_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(8)
    rows = [(k % 180, [float(x) for x in rng.normal(size=4 if k % 3 else 6)]) for k in range(400)]
    rows += [(k, [5e6, float(k)]) for k in range(2000, 2010)]  # products beyond exact floating point
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = collections.defaultdict(list)
    for r in topk.top_k(table, k=3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    v = [(k, [math.floor(64 * x) for x in e]) for k, e in rows]
    asks = {k: min(e for i, e in v if i == k) for k, _ in v if k % 20 == 0}
    for k, e in asks.items():
        want = sorted(((-sum(a * b for a, b in zip(e, f)), i) for i, f in v if i != k and len(f) == len(e)))[:3]
        assert got.pop(k) == [(i, -s) for s, i in want]
    assert not got


def test_ftrl_equals_the_update_written_out():
    """One pass of the per-coordinate update, feature by feature."""
    texts = [text(k, 12).encode() for k in range(30)]
    labels = [k % 3 == 0 for k in range(30)]
    examples = []
    for t in texts:
        doc, slot = toxicity.features([t])
        examples.append(np.unique(slot))
    slots, weights, bias = toxicity.fit(examples, [int(y) for y in labels])
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    rate = sum(labels) / len(labels)
    l1 = toxicity.L1_NOISE * math.sqrt(len(labels) * rate * (1 - rate))
    b, b_n = math.log(rate / (1 - rate)), 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for x, y in zip(examples, labels):
            w = {i: weight(i) for i in x.tolist()}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, b + sum(w.values()))))) - y
            for i, old in w.items():
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * old
                n[i] += g * g
            b_n += g * g
            b -= toxicity.ALPHA * g / (toxicity.BETA + math.sqrt(b_n))
    want = {i: weight(i) for i in list(z) if weight(i)}
    assert want and dict(zip(slots.tolist(), weights.tolist())) == pytest.approx(want, abs=1e-9)
    assert bias == pytest.approx(b, abs=1e-9)


def test_hypergeometric_beyond_the_library():
    rng = np.random.default_rng(11)
    big = 4 * 10**9
    for good, bad, n in ((big, 3 * big, 2 * big), (3 * big, big, 10**6), (big, 2 * big, 3 * big - 5), (big, big, 40), (7, 5 * big, big)):
        draws = np.array([mixing.hypergeometric(rng, good, bad, n) for _ in range(400)], float)
        total = good + bad
        mean, var = n * good / total, n * good / total * bad / total * (total - n) / (total - 1)
        assert max(0, n - bad) <= draws.min() and draws.max() <= min(n, good)
        assert abs(draws.mean() - mean) <= 5 * math.sqrt(var / 400) + 1e-9
        assert var < 1 or 0.7 < draws.var() / var < 1.4


def test_splitting_tree_of_huge_quotas(spark):
    quotas = {0: 3_000_000_000, 1: 9_000_000_000_000, 2: 1, 3: 1_500_000_000}
    leaf = mixing.splitting_tree(spark.createDataFrame(list(quotas.items()), "rank long, quota long"), 7).collect()
    for rank, n in quotas.items():
        of = sorted((r["begin"], r["n"]) for r in leaf if r["rank"] == rank)
        assert sum(x for _, x in of) == n and [b for b, _ in of] == list(np.cumsum([0] + [x for _, x in of[:-1]]))
    per = collections.Counter()
    for r in leaf:
        per[r["shard"]] += r["n"]
    assert max(per.values()) - min(per.values()) <= 4


def test_splitting_tree_of_many_sources(spark):
    n = 100_000
    quotas = spark.range(n).selectExpr("id AS rank", "1 + id % 5 AS quota")
    leaf = mixing.splitting_tree(quotas, 50)
    assert leaf.groupBy("rank").agg(F.sum("n").alias("n")).where("n = 1 + rank % 5").count() == n
    per = {r["shard"]: r["n"] for r in leaf.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert len(per) == 50 and sum(per.values()) == 3 * n and max(per.values()) - min(per.values()) <= 8
    # draws of a source are numbered without a gap, shard after shard
    gaps = leaf.groupBy("rank").agg(F.max(F.col("begin") + F.col("n")).alias("end"), F.min("begin").alias("first"), F.sum("n").alias("n"))
    assert gaps.where("first <> 0 or end <> n").count() == 0


def test_sources_are_ranked_in_ranges(spark):
    names = [None, *(f"s{k:05d}" for k in range(3000)), "é", "Z", ""]
    sums = spark.createDataFrame([(x, 1) for x in reversed(names)], "source string, source_size long").repartition(9)
    got = {r["source"]: r["rank"] for r in mixing._ranked(sums).collect()}
    assert got == {x: i for i, x in enumerate([*sorted(x for x in names if x is not None), None])}
    assert mixing._ranked(sums.limit(0)).count() == 0


def test_one_key_opens_one_bucket_and_one_shard(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_IDS", 300)
    monkeypatch.setattr(tokenfiles, "BUCKET_KEYS", 8)
    monkeypatch.setattr(tokenfiles, "GROUP_BUCKETS", 4)
    path = scratch_path(spark, "t")
    rows = [(3 * k, text(k, 20), "a") for k in range(200)] + [(None, "x", "a"), (30, "again", "a")]
    tokenfiles.write(docs(spark, rows).repartition(4), path, tokenizer_path())
    enc = Encoder(tokenizer_path())
    opened = []
    real = type(spark.read).parquet

    def parquet(reader, *paths, **options):
        df = real(reader, *paths, **options)
        opened.append(df.inputFiles())
        return df

    monkeypatch.setattr(type(spark.read), "parquet", parquet)
    for k in (0, 57, 597, -1, 5):
        opened.clear()
        got = tokenfiles.read_one(spark, path, k)
        if k in (-1, 5):
            assert got is None and len(opened) == 2
        else:
            assert got.tolist() == [*enc.whole(dict((i, t) for i, t, _ in rows if t != "again")[k]), 0]
            assert [len(f) for f in opened] == [1, 1, 1]  # a folder's bucket count, the key's bucket, its shard
    plan = tokenfiles.index_row(spark, path, 0).where("bucket = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(bucket,3)" in plan
    assert len(tokenfiles.index(spark, path).inputFiles()) > 3


def test_a_preface_of_many_items_is_no_evidence(spark):
    preface = text(70, 16)
    items = [(k, f"{preface} {text(500 + k, 40)}") for k in range(200)]
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, source string")
    rows = [(k, f"{text(900 + k, 10)} {preface} {text(950 + k, 10)}", "a") for k in range(30)]
    rows += [(100, f"some words {items[7][1]} more", "a"), (101, " ".join(items[9][1].split()[16:]), "a"), (102, " ".join(items[11][1].split()[20:34]), "a")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(100, 7), (101, 9), (102, 11)}
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(docs(spark, rows), bench).collect()) == list(range(30))
    # copies of one item, however many, are still found: they are one text
    many = spark.createDataFrame([(k, items[3][1], "x") for k in range(120)], "item_id long, text string, source string")
    assert decontaminate.contaminated(docs(spark, [(1, items[3][1], "a")]), many).count() == 120
    # items made of common windows only are known by them
    same = spark.createDataFrame([(k, f"{preface} end{k}", "x") for k in range(120)], "item_id long, text string, source string")
    assert decontaminate.contaminated(docs(spark, [(1, f"{preface} end5", "a")]), same).where("item_id = 5").count() == 1


def test_redact_keeps_texts_with_their_spans(spark):
    rows = [(k % 7, f"row {k} mail u{k}@site.org end", "a") for k in range(200)] + [(1, "row 5 mail u5@site.org end", "a")] * 3
    out = pii.redact(docs(spark, rows).repartition(11)).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in out) == collections.Counter(
        (i, re.sub(r"u\d+@site.org", "[email]", t)) for i, t, _ in rows)
