"""Filter audit, set join and spelling variants against brute force, and faults of earlier operators."""

import collections
import itertools
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import tidecast
from tests.conftest import ROOT
from tidecast.llm import filter_audit, jaccard_join, language_id, mixing, sharding, simhash, spelling, spread, tool_calls

cloudpickle.register_pickle_by_value(tidecast)
CLASHING = "doc_id long, text string, source string, part string, word string, _id int, n int, step int, _class int, _doc int"


def table(spark, rows):
    """Rows (id, text, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "p", "w", 1, 2, 3, 4, 5) for r in rows], CLASHING).repartition(4)


# Filter audit


def audit_by_hand(rows, labels):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))

    def fails(i, t):
        t = t or ""
        w = [x for x in t.replace("\n", " ").replace("\t", " ").split(" ") if x]
        return {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > smallest[t],
        }

    out = collections.Counter()
    for part in {s or "" for _, _, s in rows}:
        own = [(fails(i, t), labels.get(i, (0, 0))) for i, t, s in rows if (s or "") == part]
        shapley = collections.Counter()
        lines = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = own, []
            for step, x in enumerate(order, 1):
                out_now = [d for d in left if d[0][x]]
                again = sum(d[0][x] for d in gone)
                left, gone = [d for d in left if not d[0][x]], gone + out_now
                shapley[x] += len(out_now)
                alone = sum(d[0][x] and sum(d[0].values()) == 1 for d in own)
                lines.append((x, (part, order, step, len(left), len(out_now), again, alone, sum(d[1][0] for d in out_now), sum(d[1][1] for d in out_now))))
        out.update((*line, shapley[x]) for x, line in lines)
    return out


def test_audit_against_walking_all_orders(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("a b c D EF #x g\nh ij k l m n o p q r s t u".split(" ")) for _ in range(n)) for n in (0, 5, 49, 50, 70, 200)]
    pool += [" ".join(f"w{k}" for k in range(60)), " ".join(f"W{k}" for k in range(60)), None, "é" * 30_000, "a " * 20_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice(pool), rng.choice(["s", "t", "", None])) for _ in range(120)]
    rows += rows[:5]
    labels = {k: (k % 2, k % 3 == 0) for k in range(0, 40, 3)}
    said = spark.createDataFrame([(k, q, int(t)) for k, (q, t) in labels.items()] * 2 + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit_texts(table(spark, rows), said)
    assert collections.Counter(map(tuple, got.collect())) == audit_by_hand(rows, labels)
    assert filter_audit.audit_texts(table(spark, rows).limit(0), said).count() == 0


def test_lattice_counts_orders():
    ways = filter_audit.lattice(4)
    assert len(ways) == 32 and sum(a * b for (s, f), (a, b) in ways.items() if f == 2) == 24
    for order in itertools.permutations(range(4)):
        assert all((sum(1 << x for x in order[:k]), order[k]) in ways for k in range(4))
    with pytest.raises(ValueError):
        filter_audit.audit(None, "x", {}, {})


def test_audit_with_other_filters(spark):
    rows = spark.range(100).select((F.col("id") % 2).alias("p"), "id")
    fails = {"x": F.col("id") < 30, "y": F.col("id") >= 20, "z": F.lit(None).cast("boolean")}
    got = filter_audit.audit(rows, "p", fails, {"good": F.col("id") == 5, "toxic": F.lit(False)})
    assert got.count() == 2 * 6 * 3
    line = got.filter("part = '0' AND filter_order = 'zxy' AND step = 3").first()
    assert (line.kept, line.removed, line.redundant, line.unique_fails) == (0, 35, 5, 35) and line.shapley == 3 * 35 + 3 * 40


# Set join


def sets_of(text, words):
    w = (text or "").encode().lower().split()
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}


def joined_by_hand(rows, words, least, of):
    found = [sets_of(t, words) for _, t, _ in rows]
    up = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(found[a] & found[b])
            if both and of * both >= least * (len(found[a]) + len(found[b]) - both) and up[a] != up[b]:
                one, two = up[a], up[b]
                up = [one if u == two else u for u in up]
    ids = collections.defaultdict(list)
    for u, (i, _, _) in zip(up, rows):
        if i is not None:
            ids[u].append(i)
    return collections.Counter((i, len(s), min(ids[u], default=None) if s else i) for s, u, (i, _, _) in zip(found, up, rows))


def near_rows():
    rng = random.Random(11)
    made = []

    def word():
        return f"v{rng.randrange(4_000)}"

    for _ in range(14):
        base = [word() for _ in range(rng.randrange(12, 160))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 18))):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [word()], [copy[at], word()]])
            made.append(" ".join(copy))
    passage = " ".join(word() for _ in range(70))
    made += [f"{passage} {' '.join(word() for _ in range(rng.randrange(4, 40)))}" for _ in range(60)]
    # Two leads that are not similar, with followers that drift towards each other.
    left = [f"l{k}" for k in range(200)]
    right = left[:184] + [f"r{k}" for k in range(16)]
    made += [" ".join(left), " ".join(right)]
    made += [" ".join(left[:199] + [f"x{k}"]) for k in range(6)] + [" ".join(right[:199] + [f"y{k}"]) for k in range(6)]
    made += [" ".join(left[:184] + [f"r{k}" if k < n else f"l{184 + k}" for k in range(16)]) for n in (2, 4, 13)]
    made += ["", None, " \n", "a b", "A  b", "a b c", "a b c d", "A b c d", "w " * 30_000, made[0], made[0]]
    rows = [(k, t, "s") for k, t in enumerate(made)]
    return rows + [rows[3], (None, made[5], "s"), (None, "alone", "s"), (None, "alone", "s"), (7, "other text of a repeated id", "s")]


def test_set_join_against_brute_force(spark, monkeypatch):
    rows = near_rows()
    want = joined_by_hand(rows, 4, 85, 100)
    assert sum(i != c for i, _, c in want) > 40
    got = jaccard_join.similar_documents(table(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert collections.Counter(map(tuple, got.collect())) == want
    for name, value in (("LIST_ROWS", 5), ("BROADCAST_ROWS", 0), ("PAIRS_PER_COPY", 3), ("FAN_IN", 2)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert collections.Counter(map(tuple, jaccard_join.similar_documents(table(spark, rows)).collect())) == want
    assert jaccard_join.similar_documents(table(spark, rows).limit(0)).count() == 0


def test_set_join_at_another_threshold(spark):
    rows = near_rows()
    got = jaccard_join.similar_documents(table(spark, rows), words=2, similar=(3, 5))
    assert collections.Counter(map(tuple, got.collect())) == joined_by_hand(rows, 2, 3, 5)


def copies_of_one_text(n, words=150, most=12):
    """Copies with one to many changed, deleted or swapped places; few are similar to each other."""
    rng = random.Random(17)
    base = [f"b{rng.randrange(900)}" for _ in range(words)]
    made = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(1, most)):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[], [f"x{rng.randrange(10**6)}"], [f"x{rng.randrange(10**6)}"], [copy[at], f"y{rng.randrange(3)}"]])
        made.append(" ".join(copy))
    return [(k, t, "s") for k, t in enumerate(made)]


def test_a_large_group_of_near_copies_needs_few_comparisons(spark, monkeypatch):
    rows, compared, compare = copies_of_one_text(500), [], jaccard_join.compare
    monkeypatch.setattr(jaccard_join, "compare", lambda *a: compared.append(compare(*a)) or compared[-1])
    got = jaccard_join.similar_documents(table(spark, rows))
    want = joined_by_hand(rows, 4, 85, 100)
    assert collections.Counter(map(tuple, got.collect())) == want
    assert 50 < sum(i != c for i, _, c in want) < 450
    assert sum(n for _, n in compared) < 20 * len(rows)  # there are 125 000 pairs


def test_near_copies_in_lists_without_partners_make_no_pairs(spark, monkeypatch):
    """Most copies are similar to no other: fewer pairs leave the lists, with the same links."""
    made, with_partners = [], jaccard_join.with_partners

    def emitted(entries, lists):
        found = entries.join(lists.select("_h"), "_h", "left_semi").withColumns({"_task": F.lit(0), "_role": F.lit(jaccard_join.WHOLE)})
        rows = found.orderBy("_h", "_task", "_role", *jaccard_join.ENTRY).toArrow()
        return sum(b.num_rows for b in jaccard_join.class_pairs(rows, (85, 100)))

    def watched(entries, similar):
        found = with_partners(entries, similar)
        before = entries.withColumn("_lists", F.lit(1 << 62)), jaccard_join._lists_apart(entries)[0]
        made.append((emitted(*before), emitted(*found)))
        return found

    monkeypatch.setattr(jaccard_join, "with_partners", watched)
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_ENTRY", 2)
    rng, rows = random.Random(5), []
    for k in range(600):  # words are replaced, so sizes are alike
        copy = [f"b{j}" for j in range(150)]
        for j in rng.sample(range(150), rng.randrange(1, 16)):
            copy[j] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy), "s"))
    got = jaccard_join.similar_documents(table(spark, rows))
    assert collections.Counter(map(tuple, got.collect())) == joined_by_hand(rows, 4, 85, 100)
    (before, after), = made
    assert before > 50 * len(rows) and 2 * after < before, (before, after)


def test_templates_make_few_candidates(spark):
    """Texts with 85 % of their words in common but a similarity below the threshold."""
    rng = random.Random(1)
    frame = [f"t{k}" for k in range(170)]
    made = [" ".join(frame + [f"u{rng.randrange(10**9)}" for _ in range(30)]) for _ in range(2_000)]
    texts = spark.createDataFrame(list(enumerate(made)), "_id long, _text string").withColumn("_key", jaccard_join.text_key("_text")).repartition(8)
    ranks = jaccard_join.rarity(texts, 5)
    run = jaccard_join._described(5, (4, 5), ranks, lambda found: b"")
    sets = texts.select("_id", "_key", "_text").mapInArrow(run, "_id long, _key binary, _set binary, _size long, _prefix binary, _print binary")
    sets = spread.materialize(sets.withColumn("_doc", F.col("_id")), "sets")
    shared = jaccard_join.shared_postings(sets, ranks)
    info = spark.createDataFrame([], "_d long, _group long, _class long, _in long")
    assert jaccard_join.candidates(shared, info, (4, 5)).count() < 2_000
    table_ = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    assert simhash.keep_one(table_).count() == 2_000


def test_rarity_counts_every_set(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FAN_IN", 3)
    made = [" ".join(f"w{j + k % 7}" for j in range(30)) for k in range(40)]
    texts = spark.createDataFrame([(t,) for t in made], "_text string").repartition(11)
    ranks = jaccard_join.rarity(texts, 2)
    import pyarrow as pa

    counts = np.zeros(1 << jaccard_join.SKETCH_BITS)
    for found in jaccard_join.shingle_sets(pa.array(made), 2):
        np.add.at(counts, jaccard_join._bucket(found), 1)
    assert (ranks == jaccard_join.rank_of(counts)).all() and ranks.max() > 8


# Spelling variants


def variants_by_hand(rows):
    n = collections.Counter()
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, t, _ in rows:
        run = ""
        for c in (t or "") + "\0":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            word, run = run.translate(low), ""
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if word and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    beside = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, some in beside.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(beside[w]), n[form[w]] if form[w] else None))
    return out


def spelt_rows():
    rng = random.Random(6)
    rows = []
    for k in range(80):
        made = []
        for word, times in (("government", 9), ("Ärgernisse", 3), ("straßenbahn", 2), ("ÄRGERNISSE", 1), ("tretion", 2), ("question", 2)):
            for _ in range(times):
                w = word
                if rng.random() < 0.12:
                    at = rng.randrange(len(w))
                    w = w[:at] + rng.choice(["", "x", w[at] + "y"]) + w[at + 1 :]
                made.append(rng.choice([w, w.title(), w + "s"]) if rng.random() < 0.2 else w)
        rng.shuffle(made)
        rows.append((None if k == 7 else k, rng.choice([" ", "-", "1", "\n"]).join(made), "s"))
    # A chain of forms: 200, 20 and 2 occurrences.
    rows += [(400, f"{'q' * 63}x {'q' * 64}x {'q' * 64} {'q' * 65}", "s"), (401, f"{'q' * 63}x {'q' * 64}x {'q' * 64} {'q' * 65}", "s")]
    rows.append((500, "abcdefgh " * 2 + "abcdefgx " * 25 + "abcdefyx " * 400, "s"))
    return rows + [(600, None, "s"), (601, "", "s"), (602, "z" * 20_000, "s"), (603, "z" * 20_000, "s"), rows[0], rows[0]]


def test_spelling_against_brute_force(spark):
    rows = spelt_rows()
    want = variants_by_hand(rows)
    assert sum(w[1] is not None for w in want) > 20 and any(w[2] != w[1] for w in want if w[1])
    got = spelling.variants(table(spark, rows)).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    for symbols in (1, 2, 7):
        assert set(map(tuple, spelling.variants(table(spark, rows), symbols=symbols).collect())) == want
    assert spelling.variants(table(spark, rows).limit(0)).count() == 0


def test_neighbourhood_is_full_and_has_nothing_twice():
    table = spelling.symbol_table(3)
    codes = np.array([[ord(c) for c in w] for w in ("abcabba", "aaaaaaa", "zyxwvut")], np.uint32)
    made = [(r, k) for rows, keys in spelling.neighbour_keys(codes, table, 3) for r, k in zip(rows.tolist(), keys.tolist())]
    assert len(made) == len(set(made))
    power = spelling._powers(9)
    for row, word in enumerate(table[codes].tolist()):
        want = {tuple(word)}
        for k in range(len(word) + 1):
            want |= {(*word[:k], m, *word[k:]) for m in (1, 2, 3)}
            if k < len(word):
                want |= {(*word[:k], m, *word[k + 1 :]) for m in (1, 2, 3)} | {(*word[:k], *word[k + 1 :])}
        keys = {int((np.array(w, np.uint64) * power[: len(w)]).sum(dtype=np.uint64)) for w in want}
        assert keys == {k for r, k in made if r == row} and len(keys) == len(want)


# Faults of earlier operators


def test_language_stage_keeps_texts_when_nothing_was_learned(spark):
    rows = [(k, f"some words of text {k}", None, 1) for k in range(20)] + [(90, "12 34", None, 1), (91, None, None, 1), (92, "", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text int")
    kept = language_id.keep_known(docs, language_id.train(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_language_stage_rejects_little_of_what_it_has_not_seen(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    kept = language_id.keep_known(docs, language_id.train(docs)).count()
    assert kept >= 0.98 * docs.filter(F.col("text").rlike("[A-Za-z]")).count()


def test_mixing_rows_that_share_an_id(spark):
    docs = spark.createDataFrame([(5, " ".join(["w"] * 10), "a", k) for k in range(1_000)] + [(None, "x y", "b", 1)] * 50, "doc_id long, text string, source string, k int")
    plan = mixing.mix_plan(docs)
    for r in plan.groupBy("source_size").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("size")).collect():
        assert abs(r.taken - r.target) <= r["size"]
    taken = plan.agg(F.sum("taken")).first()[0]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.agg(F.sum(mixing.word_count("text"))).first()[0] == taken
    assert mixed.groupBy("doc_id", "k").count().filter("doc_id IS NOT NULL AND count > 2").count() == 0


def test_tool_calls_that_are_no_plain_json(spark):
    odd = ['{"k":1e999}', '{"k":"\\ud800"}', '{"k":1,"k":2}', "[" * 100_000, None, '{"k":NaN}']
    rows = [(1, k, "call", f"c{k}", "t", a, None, None) for k, a in enumerate(odd)]
    messages = spark.createDataFrame(rows, "conv_id long, turn int, kind string, call_id string, tool string, arguments string, content string, after string")
    got = {r.turn: (r.valid, r.problems) for r in tool_calls.link_calls(messages, {"t": {"type": "object"}}).collect()}
    assert got.pop(2) == (True, None)
    assert set(got.values()) == {(False, "arguments are no JSON")}


def test_numbers_part_equal_rows(spark):
    rows = spark.range(300_000).select(F.lit(1).alias("a"))
    numbered = spread.number_rows(rows, 300_000, "a")
    assert numbered.agg(F.count_distinct("row_no"), F.max("row_no")).first()[:] == (300_000, 299_999)
    assert numbered.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] < 200_000


def test_shards_are_even(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for size in (sharding.BIN, 40):
        monkeypatch.setattr(sharding, "BIN", size)
        sizes = [r[1] for r in sharding.shard(docs, 8).groupBy("shard").agg(F.sum("size")).orderBy("shard").collect()]
        largest = max(r[0] for r in docs.select(F.octet_length("text")).collect())
        assert len(sizes) == 8 and max(sizes) - min(sizes) <= largest


def test_queries_run_where_workers_lack_the_package(tmp_path):
    """Started elsewhere: workers must not need to import the package."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; from tidecast.session import build_session; "
        "sys.path.remove(sys.path[0]); spark = build_session('t', 'local[2]', 2); q = e.queries(); "
        "[print(n, q[n](spark, '/root/testdata/sf0.001').count()) for n in sorted(q) if n.startswith('op') or n in ('score_strict', 'udtf_train')]"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr[-2_000:]
    assert run.stdout.count("\n") >= 15
