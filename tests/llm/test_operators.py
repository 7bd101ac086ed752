"""Edge cases of every operator against brute force: nulls, ties, repeats, empty and odd tables."""

import base64
import collections
import hashlib
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark import cloudpickle

import corpus_pipeline
import tidecast
from tidecast.llm import (
    bpe, exact_dedup, language_id, mixing, quality_crf, queries, rlz_dedup, sharding, simhash, tool_calls, warc,
)
from tidecast.session import scratch_path

cloudpickle.register_pickle_by_value(tidecast)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, shard string, _row int, n int"
PASSAGE = " ".join(f"w{k}" for k in range(20))


def texts():
    rng = random.Random(5)
    made = [None, "", " \n\t", "one", "one", "on e", "###", f"a {PASSAGE} b", f"{PASSAGE} c", f"x {PASSAGE}", "é日本 🙂 <|endoftext|> 's"]
    made += [" ".join(rng.choice("the of and in a le la der die das cat".split()) for _ in range(60)) for _ in range(20)]
    return made + ["lo ng " * 30_000, "z" * 3_000, made[-1], made[-1]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if k == 9 else k // 2 if k == 4 else k, t, "en" if k % 2 else "fr", None if k % 5 == 0 else f"s{k % 4}", 1, "i", "s", 1, 2)
            for k, t in enumerate(texts())]
    rows.append(rows[-1])
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def test_exact_dedup(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    form = lambda t: bytes(b for b in (t or "").encode() if b not in b" \t\n\v\f\r")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[form(t)].append((-len(t or ""), i is None, i))
    want = collections.Counter(
        (i, min(g)[2], len(g), i == min(g)[2] and len(t or "") == -min(g)[0], hashlib.sha256(form(t)).hexdigest())
        for i, t in rows
        for g in [groups[form(t)]]
    )
    assert collections.Counter(map(tuple, exact_dedup.exact_dedup(docs).collect())) == want
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == sum(n for r, n in want.items() if r[3])
    assert exact_dedup.exact_dedup(empty).count() == 0 == exact_dedup.keep_first(empty).count()


def test_quality_counts_and_viterbi(docs, empty):
    field = quality_crf.Field(np.linspace(-1, 1, len(quality_crf.FEATURES)), np.array([[0.4, -0.3], [-0.2, 0.6]]))
    got = sorted(map(tuple, quality_crf.judge(docs, field).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=repr)
    want = []
    for r in docs.collect():
        t, w = r.text or "", words(r.text)
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        want.append((r.doc_id, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)))
    assert got == sorted(want, key=repr)
    rng = random.Random(2)
    for _ in range(30):
        bits = [rng.randrange(1 << len(quality_crf.FEATURES)) for _ in range(7)]
        def score(path):
            return sum(field.scores[b] for b, s in zip(bits, path) if s) + sum(field.move[a, b] for a, b in zip(path, path[1:]))
        best = max(score([k >> j & 1 for j in range(7)]) for k in range(128))
        assert score(field.viterbi(bits)) == pytest.approx(best)
    assert quality_crf.judge(empty, field).count() == 0


def test_field_learns_lines():
    good, bad = [1 | 4 | 256] * 8, [1 | 8 | 16 | 32] * 8
    field = quality_crf.fit([good, bad] * 20, [1, 0] * 20)
    assert field.viterbi(good) == [1] * 8 and field.viterbi(bad) == [0] * 8
    assert quality_crf.fit([], []).viterbi([]) == []


def test_warc_round_trip(spark):
    rows = [(5, "http://a b/", "x", 1), (2, None, "x", 1), (2, "u", "x", 1), (None, "u", "x", 1), (7, "u", None, 1), (8, "ü\r\nX: y", "", 1),
            (None, "u", "only null", 1), (9, "u", "é" * 50_000 + "\r\n\r\nWARC/1.1", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _key int")
    folders = [scratch_path(spark, "warc") for _ in range(3)]
    for f in folders[:2]:
        warc.write_archives(pages, f, shard_bytes=1_000, roll_bytes=300)
    got = collections.Counter(map(tuple, warc.read_archives(spark, folders[0]).collect()))
    first = {"x": 2, "": 7, "only null": None}
    want = collections.Counter()
    for i, _, html, _ in rows:
        data, to = (html or "").encode(), first.get(html or "", i)
        revisit = to is not None and i != to
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None)] += 1
    assert got == want
    one, two = (sorted((r.name, r.sha256) for r in warc.manifest(spark, f).collect()) for f in folders[:2])
    assert one == two and len(one) > 1
    warc.write_archives(pages.limit(0), folders[2])
    assert warc.read_archives(spark, folders[2]).count() == 0


def test_bpe_against_the_library(docs, empty):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    want = collections.Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, bpe.round_trip(docs, path).collect())) == want
    back = bpe.decode(bpe.encode(docs, path), path)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in docs.collect())
    assert bpe.round_trip(empty, path).count() == 0
    model, rng = bpe.load(path), random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice(["a", " ", "\n", "the", "'s", "1", "é", "\t", "!", "日", "<|endoftext|>", "x" * 90]) for _ in range(30))
        assert model.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_workers_free_the_tokenizer_for_other_operators():
    """A worker keeps tokenizer and cache from task to task, until another operator reads texts in it."""
    path, batch = queries.tokenizer(), pa.RecordBatch.from_pydict({"_id": [1], "_text": ["a text of words"]})
    for _ in range(2):
        assert list(bpe._digests(path)(iter([batch])))[0].num_rows == 1
        kept = [x for x in vars(sys).values() if isinstance(x, dict) and path in x]
        assert len(kept) == 1
    fields = ["_id", "_print"]
    assert list(simhash._fingerprints("_text", 3, 64, fields)(iter([batch])))[0].schema.names == fields
    assert not [x for x in vars(sys).values() if isinstance(x, dict) and path in x]


def test_sharding(docs, empty):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == docs.count() and {r.law for r in got} == {"bytes"}
    for k in {r.shard for r in got}:
        own = [r.slot for r in got if r.shard == k]
        assert sorted(own) == list(range(len(own)))
    by_text = {(r.text_crc32, r.size): set() for r in got}
    for r in got:
        by_text[(r.text_crc32, r.size)].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert sharding.shard(empty, 4).count() == 0
    rng = random.Random(3)
    sizes = [rng.randrange(1, 1000) for _ in range(400)]
    sums = [0] * 8
    for size, k in zip(sizes, sharding.difference(sizes, 8)):
        sums[k] += size
    assert max(sums) - min(sums) <= 20
    base = [500.0, 0, 0, 900, 0, 0, 0, 0]
    sums = list(base)
    for size, k in zip(sizes, sharding.difference(sizes, 8, base)):
        sums[k] += size
    assert max(sums) - min(sums) <= 20


def test_tool_calls(spark):
    rows = [(1, 0, "call", "a", "t", '{"q": "x", "k": 1}', None, None), (1, 1, "result", "a", None, None, "é", None),
            (1, 2, "call", "b", "t", '{"k":true}', None, "a"), (1, 3, "call", "b", "t", "{", None, None), (1, 4, "result", "z", None, None, None, None),
            (1, 5, "call", "c", "u", None, None, "d"), (1, 6, "call", "d", "t", '{"q":"x"}', None, "c"), (1, 7, "user", None, None, None, "hi", None),
            (None, 1, "call", "a", "t", '{"q":"x"}', None, "missing"), (1, 8, "call", None, "t", "[]", None, None)]
    rows += [(2, k, "call", f"n{k}", "t", '{"q":"x"}', None, f"n{k - 1}") for k in range(40)]
    schema = "conv_id long, turn long, kind string, call_id string, tool string, arguments string, content string, after string"
    messages = spark.createDataFrame(rows, schema)
    kinds = {"t": {"type": "object", "required": ["q"], "properties": {"k": {"type": "integer"}}}}
    got = {(r.conv_id, r.turn): r for r in tool_calls.link_calls(messages, kinds).collect()}
    assert len(got) == len(rows)
    assert [got[1, k].status for k in range(9)] == ["linked", "linked", "no result", "repeated", "no call", "no result", "no result", None, "no id"]
    assert [got[1, k].step for k in range(8)] == [0, 1, 2, None, None, None, None, None] and got[None, 1].step == 0
    assert [got[2, k].step for k in range(40)] == [2 * k for k in range(40)]
    assert got[1, 0].valid and got[1, 0].json == '{"arguments":{"k":1,"q":"x"},"id":"a","name":"t","type":"tool_call"}'
    assert got[1, 2].problems == "$.q: missing; $.k: not of type integer" and got[1, 3].problems == "arguments are no JSON"
    assert tool_calls.link_calls(messages.limit(0), kinds).count() == 0


def test_substring_dedup(docs, empty):
    rows = [(1 << 62 if r.doc_id is None else r.doc_id, words(r.text)) for r in docs.collect()]
    first = {}
    for i, w in rows:
        for a in range(len(w) - 12):
            g = tuple(w[a : a + 13])
            first[g] = min(first.get(g, i), i)
    want = collections.Counter()
    for i, w in rows:
        gone = {a + k for a in range(len(w) - 12) if first[tuple(w[a : a + 13])] < i for k in range(13)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[(None if i == 1 << 62 else i, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    assert collections.Counter(map(tuple, rlz_dedup.substring_dedup(docs).collect())) == want
    assert rlz_dedup.substring_dedup(empty).count() == 0


def test_language_id(spark, docs, empty, sf_small):
    table = spark.read.parquet(os.path.join(os.path.dirname(sf_small), "sf0.01", "documents.parquet"))
    model = language_id.train(table)
    found = language_id.predict(table, model).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)
    odd = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert odd[0] == odd[1] == odd[6] == "und" and odd[10] != "und"
    assert language_id.keep_known(docs, model).columns == docs.columns
    none = language_id.train(empty)
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    code = language_id.codewords(9)
    assert min((a != b).sum() for k, a in enumerate(code) for b in code[:k]) > 10


def test_mixing(docs, empty):
    got = mixing.mix_plan(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_plan(docs.repartition(3)).collect()), key=repr)
    assert sorted(r.size for r in got) == sorted(len(words(r.text)) for r in docs.collect())
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    targets = {(r.source_size, r.target) for r in got}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * sum(r.size for r in got))
    assert mixing.mix_plan(empty).count() == 0 == mixing.mix(empty).count()
    assert mixing.mix(docs).columns == docs.columns
    weights, parts = [random.Random(4).randrange(1, 50) for _ in range(500)], [0.3] * 500
    want = sum(w * p for w, p in zip(weights, parts))
    done = mixing.pivot(weights, parts, random.Random(1))
    rest = sum(w * p for w, p, d in zip(weights, parts, done) if d is None)
    assert sum(w * (d or 0) for w, d in zip(weights, done)) + rest == pytest.approx(want)
    assert sum(d is None for d in done) <= 1


def test_simhash(docs, empty):
    def print_(t):
        w = words((t or "").lower())
        runs = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = np.array([xxhash.xxh64_intdigest(r, 42) for r in runs], np.uint64)
        return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(runs))

    got = simhash.near_groups(docs).collect()
    rows = [(r.doc_id, print_(r.text)) for r in docs.collect()]
    assert collections.Counter((r.doc_id, int(r.fingerprint, 16)) for r in got) == collections.Counter(rows)
    near = {a: {b for _, b in rows if (a ^ b).bit_count() <= 3} for _, a in rows}
    for r in got:
        seen, todo = set(), [int(r.fingerprint, 16)]
        while todo:
            a = todo.pop()
            if a not in seen:
                seen.add(a)
                todo += near[a]
        assert r.component_id == min((i for i, p in rows if p in seen and i is not None), default=None)
    assert simhash.near_groups(empty).count() == 0 == simhash.keep_one(empty).count()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {0, 1, 2} <= {r.doc_id for r in kept.collect()}


def test_forest_and_cut_shards(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.int64)
    prints = {int(centre) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (120, 2))} | set(rng.integers(0, 1 << 62, 200).tolist())
    table = spark.createDataFrame([(p.to_bytes(8, "big"),) for p in prints], "_print binary")
    def roots(links):
        return {(bytes(r.node), bytes(r.root)) for r in simhash.components(links, 50).collect()}
    whole = roots(simhash.link(table, len(prints), 64, 3))
    monkeypatch.setattr(simhash, "SHARD_ROWS", 16)
    assert roots(simhash.link(table, len(prints), 64, 3)) == whole and whole


def test_pipeline(spark, sf_small):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    out = corpus_pipeline.run(spark, sf_small)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = out.collect()
    raw = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(sf_small, "documents.parquet")).collect()}
    assert got and all(r.decoded_sha256 == hashlib.sha256(raw[r.doc_id].encode()).hexdigest() for r in got)
    assert max(collections.Counter(r.doc_id for r in got).values()) <= 2


def test_equal_separators_make_no_copies(spark):
    rng = random.Random(3)
    made = [" ".join([f"v{rng.randrange(10**9)}" for _ in range(200)] + ["-"] * 90) for _ in range(5)]
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    assert simhash.keep_one(table).count() == 5


def near_texts():
    rng = random.Random(8)
    made, word = [], lambda: f"v{rng.randrange(10**9)}"
    for k in range(6):  # different texts, one separator
        made.append(" ".join([word() for _ in range(150)] + ["-"] * 80))
    for cut in (1, 2, 3, 4, 5, 6, 7, 8, 9):  # copies from far above to below the threshold
        for _ in range(4):
            base = [word() for _ in range(200)]
            copy = list(base)
            for at in rng.sample(range(5, 195), cut):
                copy[at] = word()
            made += [" ".join(base), " ".join(copy)]
    base = [word() for _ in range(120)]  # a chain and a hub
    for _ in range(25):
        base = list(base)
        base[rng.randrange(120)] = word()
        made.append(" ".join(base))
    return made + ["Two Words", "two words", "", None, " "]


def test_near_copies_against_brute_force(spark, monkeypatch):
    made = near_texts()
    runs = [{b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in (words((t or "").lower()) for t in made)]
    up = list(range(len(made)))
    for a in range(len(made)):
        for b in range(a):
            if runs[a] and runs[b] and 5 * len(runs[a] & runs[b]) >= 4 * len(runs[a] | runs[b]):
                one, two = sorted((up[a], up[b]))
                up = [one if u == two else u for u in up]
    table = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(5)
    want = sorted(set(up))
    assert sorted(r.doc_id for r in simhash.keep_one(table).collect()) == want and len(want) > 30
    monkeypatch.setattr("tidecast.llm.jaccard_join.LIST_ROWS", 6)
    monkeypatch.setattr("tidecast.llm.jaccard_join.BROADCAST_ROWS", 0)
    assert sorted(r.doc_id for r in simhash.keep_one(table).collect()) == want


def test_sampled_tables_meet_pairs_at_the_radius_at_any_size():
    for n in (4_096, 88_000, 2_000_000, 16_000_000):
        tables = simhash._tables(n, 128, 19)
        differ = np.argsort(np.random.default_rng(7).random((10_000, 128)), axis=1) < 19
        met = np.zeros(len(differ), bool)
        for bits in tables:
            met |= ~differ[:, bits].any(axis=1)
        assert met.mean() > simhash.RECALL - 0.004


def test_dedup_keeps_one_row_of_repeated_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e\tf"), (2, "a b c d e f"), (None, "x y"), (None, "x y"), (3, "z"), (4, ""), (4, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for part, ids in ((exact_dedup.keep_first(table), [1, 3, 4, None]), (simhash.keep_one(table), [1, 3, 4, 4, None])):
        assert sorted((r.doc_id for r in part.collect()), key=repr) == sorted(ids, key=repr)


def test_bounds_gather_a_hot_id_once(spark, monkeypatch):
    one_in = 3_000 // (2 * warc.SAMPLED)
    chosen = [r[0] for r in spark.range(2_000).filter(f"pmod(xxhash64(id), {one_in}) = 0").collect()]
    ids = spark.createDataFrame([(k,) for k in [*range(2_000), *[chosen[3]] * 1_000]], "_id long")
    gathered, collect = [], type(ids).collect
    monkeypatch.setattr(type(ids), "collect", lambda df: gathered.append(collect(df)) or gathered[-1])
    rows = sorted(chosen + [chosen[3]] * 1_000)
    assert warc._bounds(ids, 3_000, 2) == [rows[len(rows) // 2]]
    assert len(gathered[0]) == len(chosen)
