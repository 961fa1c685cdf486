"""Operators that compare texts with each other, mixing and the pipeline."""

import hashlib
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from tests.llm.helpers import AWKWARD, frame, prose, repeats, sha, stored, words
from tradelane.llm import exact, linking, lines, minhash, mixing, packing, substring, tables
from tradelane.llm.tables import cut

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_exact_dedup", "op8_mixing", "op10_substring_dedup"])
def test_query_matches_sql(spark, name):
    assert compare.compare(spark, compare.connect(SMALL), name, entry.queries()[name],
                           entry.oracle_sql()[name], SMALL) is None


@pytest.mark.parametrize("max_bits", [exact.MAX_BITS, 256])
def test_exact_dedup(spark, max_bits):
    made = AWKWARD + [f"text {i % 7}" for i in range(60)] + ["TEXT 1", "É", "é"]
    ids = [*range(len(made) - 2), None, 3]
    got = exact.exact_dedup(frame(spark, made, ids), max_bits=max_bits).collect()
    low = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in made]
    groups = {}
    for i, t in zip(ids, low, strict=True):
        groups.setdefault(sha(t), []).append(-1 if i is None else i)
    assert len(got) == len(made)
    assert Counter((r.text_sha256, -1 if r.doc_id is None else r.doc_id, r.group_size) for r in got) == Counter(
        (h, i, len(g)) for h, g in groups.items() for i in g)
    kept = [(r.text_sha256, -1 if r.doc_id is None else r.doc_id) for r in got if r.kept]
    assert sorted(kept) == sorted((h, max(g)) for h, g in groups.items())


def test_exact_dedup_of_repeated_rows_and_nothing(spark):
    docs = frame(spark, ["a"] * 5 + [None], ids=[1, 1, 1, 1, 1, 2])
    got = exact.exact_dedup(docs).collect()
    assert sum(r.kept for r in got) == 2 and {r.group_size for r in got} == {1, 5}
    assert exact.exact_dedup(docs.limit(0)).count() == 0


def brute_lines(texts, min_lines, long_line):
    """Texts without later copies, texts in the order of their ids."""
    real = [[(j, x) for j, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\f\r")] for t in texts]
    seen, out = set(), []
    for t, own in zip(texts, real, strict=True):
        gone = set()
        for i in range(len(own)):
            run = tuple(x for _, x in own[i:i + min_lines])
            if len(run) == min_lines:
                if run in seen:
                    gone |= {j for j, _ in own[i:i + min_lines]}
                seen.add(run)
            if len(own[i][1]) >= long_line:
                one = (own[i][1], "alone")
                if one in seen:
                    gone.add(own[i][0])
                seen.add(one)
        out.append("\n".join(x for j, x in enumerate((t or "").split("\n")) if j not in gone))
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_line_dedup(spark, tmp_path, min_lines):
    r = random.Random(min_lines)
    made = ["\n".join(r.choice(["a", "b", "c", "", " ", "l" * 50, f"u{r.random()}"]) for _ in range(r.randint(1, 25)))
            for _ in range(60)] + AWKWARD
    docs = stored(frame(spark, made), spark, tmp_path)
    got = lines.dedup_lines(docs, min_lines)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "longest_run"]
    rows = {x.doc_id: x for x in got.collect()}
    for i, want in enumerate(brute_lines(made, min_lines, 40)):
        assert (rows[i].text or "") == want, i
        assert rows[i].n_removed == len([x for x in (made[i] or "").split("\n") if x.strip(" \t\n\x0b\f\r")]) - len(
            [x for x in want.split("\n") if x.strip(" \t\n\x0b\f\r")])


def test_longest_runs_and_clashing_names(spark, tmp_path):
    """Runs of all lengths, some that overlap; every other column comes back as it was."""
    r = random.Random(3)
    source = [f"line {i}" for i in range(200)]
    made = ["\n".join(source)]
    for i in range(40):
        a, n = r.randrange(180), r.choice([1, 2, 3, 5, 8, 17, 60])
        b, m = r.randrange(180), r.choice([0, 3, 4])
        made.append("\n".join([f"own {i}", *source[a:a + n], *source[b:b + m], f"more {i}"]))
    docs = stored(frame(spark, made), spark, tmp_path).withColumn("__row", F.lit(77)).withColumn("a.b", F.lit("dots"))
    rows = {x.doc_id: x for x in lines.dedup_lines(docs).collect()}
    seen = set()
    for i, text in enumerate(made):
        own = text.split("\n")
        gone = [False] * len(own)
        for j in range(len(own) - 2):
            run = tuple(own[j:j + 3])
            if run in seen:
                gone[j:j + 3] = [True] * 3
            seen.add(run)
        best = now = 0
        for g in gone:
            now = now + 1 if g else 0
            best = max(best, now)
        assert (rows[i].longest_run, rows[i].n_removed) == (best, sum(gone)), i
        assert rows[i]["__row"] == 77 and rows[i]["a.b"] == "dots"
    assert max(x.longest_run for x in rows.values()) > 50


def test_line_dedup_of_repeated_rows_and_nothing(spark, tmp_path):
    docs = stored(frame(spark, ["a\nb\nc"] * 3 + [None], ids=[1, 1, None, None]), spark, tmp_path)
    rows = lines.dedup_lines(docs).collect()
    assert sorted(r.n_removed for r in rows) == [0, 0, 3, 3]
    assert [r.doc_id for r in rows if r.n_lines and not r.n_removed] == [None]
    assert lines.dedup_lines(stored(docs.limit(0), spark, tmp_path, "none")).count() == 0


def shingle_sets(texts):
    out = []
    for t in texts:
        w = words(t)
        out.append(set(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    return out


def brute_classes(texts):
    sets = shingle_sets(texts)
    owners = {}
    for i, s in enumerate(sets):
        for g in s or ():
            owners.setdefault(g, []).append(i)
    common = Counter((a, b) for own in owners.values() for x, b in enumerate(own) for a in own[:x])
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, b), c in common.items():
        if c >= 0.8 * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_minhash_against_all_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 16)
    r = random.Random(5)
    base = [prose(s, 300).split() for s in range(4)]
    made = [prose(100 + i, r.randint(1, 200)) for i in range(60)] + AWKWARD
    for b in base:  # copies at all distances around the threshold, some only linked through others
        for _ in range(40):
            w = list(b)
            for _ in range(r.randint(0, 14)):
                w[r.randrange(len(w))] = f"x{r.random()}"
            made.append(" ".join(w))
    docs = stored(frame(spark, made), spark, tmp_path)
    rows = {x.doc_id: x for x in minhash.near_dedup(docs).collect()}
    want = brute_classes(made)
    assert [rows[i].class_id for i in range(len(made))] == want
    size = Counter(want)
    assert all(rows[i].class_size == size[want[i]] and rows[i].kept == (want[i] == i) for i in range(len(made)))


def test_minhash_of_passages_repeated_differently(spark, tmp_path, monkeypatch):
    """Alike as sets, far apart by counts: each pair is found, also outside a main component."""
    monkeypatch.setattr(linking, "BLOCK", 16)
    made = []
    for i in range(25):
        body, passage = prose(i, 104), prose(1000 + i, 24)
        made += [f"{body} {passage}", f"{body} {' '.join([passage] * 30)}"]
    made += [" ".join(["one two three four five"] * n) for n in (2, 5, 40, 300)]
    docs = stored(frame(spark, made), spark, tmp_path)
    rows = {x.doc_id: x for x in minhash.near_dedup(docs).collect()}
    assert [rows[i].class_id for i in range(len(made))] == brute_classes(made)
    assert all(rows[i].class_id == i - i % 2 for i in range(50))
    # not met by leaders but in blocks
    import numpy as np
    import pyarrow as pa
    found = pa.Table.from_batches(minhash._profiles(iter([pa.record_batch(
        {"row": pa.array([0, 1]), "doc_id": pa.array([0, 1]), "text": pa.array(made[:2])})])))
    side = {c: found.column(c) for c in ("row", "ids", "counts")}
    one = pa.table({**side, "comp": pa.array([0, 1]), "inner": pa.array([False, False])})
    assert linking._meet(minhash.SIMILAR)((), one, one).to_pylist() == [{"one": 0, "two": 1}]
    assert [len(x) for x in found.column("bands").to_pylist()] == [minhash.BANDS, 2 * minhash.BANDS]
    assert np.isin(*map(np.array, found.column("bands").to_pylist())).sum() >= 0.8 * minhash.BANDS


def test_minhash_of_repeated_rows_and_nothing(spark, tmp_path):
    docs = stored(frame(spark, ["a b c"] * 4 + [None, "", "other words are these here"], ids=[7, 7, None, 3, 4, 5, 6]),
                  spark, tmp_path)
    rows = minhash.near_dedup(docs).collect()
    assert sorted((r.class_id, r.class_size) for r in rows) == [(3, 4)] * 4 + [(4, 1), (5, 1), (6, 1)]
    assert sorted(str(r.doc_id) for r in rows if r.kept) == ["4", "5", "6", "None"]
    assert minhash.near_dedup(stored(docs.limit(0), spark, tmp_path, "none")).count() == 0


def test_probability_jaccard():
    import numpy as np

    from tradelane.llm.textops import mix
    r = np.random.default_rng(1)
    x, y = r.integers(0, 4, 30).astype(float), r.integers(0, 4, 30).astype(float)
    some = (x > 0) | (y > 0)
    x, y = x[some], y[some]
    plain = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(x)) if x[i] and y[i])
    assert abs(linking.probability_jaccard(x, y) - plain) < 1e-12
    n = np.concatenate([np.zeros(len(x), int), np.ones(len(y), int)])
    h = np.tile(mix(np.arange(1, len(x) + 1).astype(np.uint64)), 2)
    w, has = np.concatenate([x, y]), np.concatenate([x, y]) > 0
    sig = minhash.signatures(n[has], h[has], w[has], 2, m=4000)
    assert abs((sig[0] == sig[1]).mean() - plain) < 0.04


def brute_substring(texts):
    split, marks = repeats(texts, 35)
    return [(len(w), sum(m), sha(" ".join(x for x, gone in zip(w, m, strict=True) if not gone)))
            for w, m in zip(split, marks, strict=True)]


@pytest.mark.parametrize("records", [substring.RECORDS, 300])
def test_substring_dedup(spark, tmp_path, monkeypatch, records):
    monkeypatch.setattr(substring, "SAMPLED", 1)
    r = random.Random(9)
    hot, cold = prose(900, 50), prose(901, 36)
    made = [*AWKWARD, hot, hot, prose(902, 34), prose(902, 34), prose(903, 35), prose(903, 35), "t " * 90]
    for i in range(150):
        w = prose(i, r.randint(0, 120)).split()
        for p in ([hot] if i % 2 else []) + ([cold] if i % 40 == 0 else []):
            at = r.randint(0, len(w))
            w[at:at] = p.split()
        made.append((" " if i % 3 else "\n").join(w))
    if records == 300:
        shards = substring.Shards(__import__("numpy").bincount([5] * 5000 + list(range(4096))), 300)
        assert shards.parts.max() > 1
    docs = stored(frame(spark, made), spark, tmp_path)
    rows = {x.doc_id: x for x in substring.remove_repeats(docs, records=records).collect()}
    assert [(rows[i].n_words, rows[i].n_removed, rows[i].kept_sha256) for i in range(len(made))] == brute_substring(made)
    for x in rows.values():
        if x.kept_text is not None:
            assert hashlib.sha256(x.kept_text.encode()).hexdigest() == x.kept_sha256


def test_substring_dedup_splits_hot_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substring, "SAMPLED", 1)
    monkeypatch.setattr(substring, "BUFFER_WORDS", 400)
    hot = prose(900, 50)
    made = [f"{prose(i, 30)} {hot} {prose(1000 + i, 30)}" for i in range(200)]
    made += [f"{prose(5000, 60)} {i}" for i in range(2)]
    found = []
    plain = substring.Shards.__init__
    monkeypatch.setattr(substring.Shards, "__init__",
                        lambda self, *a: (plain(self, *a), found.append(int(self.parts.max())))[0])
    docs = stored(frame(spark, made), spark, tmp_path)
    rows = {x.doc_id: x for x in substring.remove_repeats(docs, records=60).collect()}
    assert max(found) > 1
    assert [(rows[i].n_words, rows[i].n_removed, rows[i].kept_sha256) for i in range(len(made))] == brute_substring(made)


def test_parts_of_a_hot_shard_are_dealt_by_task_and_flush():
    """Many tasks that flush once each: neither their records nor their lists of texts meet in one group."""
    import numpy as np
    from unittest import mock

    hist = np.zeros(substring.SLOTS, np.int64)
    hist[5] = 10_000
    shards = substring.Shards(hist, 1000)
    assert shards.parts.max() >= 8
    parts, lists = Counter(), Counter()
    for task in range(400):
        with mock.patch.object(substring.TaskContext, "get", return_value=mock.Mock(partitionId=lambda t=task: t)):
            packer = substring.Packer(shards, "<u4")
            h = np.array([5 << 52], np.uint64)
            list(packer.add(np.array([task]), np.array([1]), np.array([0]), h, h, np.array([False])))
            for b in packer.flush():
                for x in b.to_pylist():
                    (lists if x["shard"] < 0 else parts)[x["shard"], x["part"]] += 1
    assert max(lists.values()) == 1 and len(lists) == 400
    assert len(parts) > 0.9 * shards.parts.max() and max(parts.values()) < 5 * 400 / len(parts)


def test_substring_dedup_of_nothing(spark, tmp_path):
    docs = stored(frame(spark, [None, "", " "], ids=[None, 1, 1]), spark, tmp_path)
    assert {(r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs).collect()} == {(0, 0, sha(""))}
    assert substring.remove_repeats(stored(docs.limit(0), spark, tmp_path, "none")).count() == 0


def brute_edf(q):
    """Slots of one period: earliest due among the released blocks, then the lower place."""
    p, done, out = sum(q), [0] * len(q), []
    for t in range(p):
        k = min((i for i in range(len(q)) if done[i] < q[i] and done[i] * p // q[i] <= t),
                key=lambda i: (-(-(done[i] + 1) * p // q[i]), i))
        out.append((k, done[k]))
        done[k] += 1
    return out


def test_mixing_stays_within_a_block(spark):
    shares = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05, "unused": 0.0}
    weights = spark.createDataFrame(list(shares.items()), "source string, weight double")
    rows = mixing.slots(weights, 40).orderBy("slot").collect()
    names = sorted(s for s in shares if shares[s])
    q = [{r.source: r.q for r in rows}[s] for s in names]
    assert [(names.index(r.source), r.nth) for r in rows] == brute_edf(q)
    done = Counter()
    for t, r in enumerate(rows, 1):
        done[r.source] += 1
        assert all(abs(done[s] - t * n / sum(q)) < 1 for s, n in zip(names, q, strict=True))


def test_many_sources_share_out_the_slots(spark):
    """2,000 sources in a tree of groups: every one stays less than a block from its share at all times."""
    import numpy as np
    weights = spark.range(2000).selectExpr("concat('s', id) AS source", "CAST(1 + id % 3 + IF(id = 7, 500, 0) AS DOUBLE) AS weight")
    rows = mixing.slots(weights).select("source", "slot", "nth", "q", "period").toPandas()
    period = int(rows.period.iloc[0])
    assert len(rows) == period and sorted(rows.slot) == list(range(period))
    per = rows.groupby("source")
    q, share = per.q.first(), dict((x.source, x.weight) for x in weights.collect())
    assert (per.size() == q).all() and q.sum() == period and len(q) == 2000
    total = sum(share.values())
    assert max(abs(q[s] / period / (w / total) - 1) for s, w in share.items()) < 0.011
    for _, x in per:
        x = x.sort_values("slot")
        n, t, k = int(x.q.iloc[0]), x.slot.to_numpy(np.int64), np.arange(len(x))
        assert (x.nth.to_numpy() == k).all()
        # before and after each of its blocks, in whole numbers
        assert (np.abs(k * period - t * n) < period).all() and (np.abs((k + 1) * period - (t + 1) * n) < period).all()


def test_light_sources_do_not_change_heavy_ones(spark):
    weights = spark.createDataFrame([("big", 0.5), *((f"t{i}", 1e-9) for i in range(300)), ("mid", 0.5)], "source string, weight double")
    rows = mixing.slots(weights, fan=16).groupBy("source").agg(F.first("q").alias("q"), F.first("period").alias("p")).collect()
    q = {r.source: r.q / r.p for r in rows}
    assert len(q) == 302 and abs(q["big"] - 0.5) < 0.005 and abs(q["mid"] - 0.5) < 0.005


def test_mixing_keeps_all_rows_in_order(spark, tmp_path):
    r = random.Random(4)
    sources = [r.choice(["big"] * 8 + ["mid"] * 3 + [None, ""]) for _ in range(600)]
    made = [prose(i, r.randint(0, 60)) for i in range(600)]
    docs = frame(spark, made + [None, None], ids=[*range(600), None, None], sources=[*sources, "only", "only"])
    placed = mixing.schedule(docs, block=2000, period=20)
    rows = placed.collect()
    assert len(rows) == 602 and all(x.slot is not None for x in rows)
    one = {}
    for x in rows:  # a slot belongs to one block of one source
        assert one.setdefault(x.slot, (x.source, x.block)) == (x.source, x.block)
    got = mixing.mixed(docs, block=2000, period=20)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    weights = spark.createDataFrame([("big", 1.0), ("mid", 1.0), (None, 2.0)], "source string, weight double")
    rest = mixing.schedule(docs, weights, block=2000).where("slot is null").collect()
    assert {x.source for x in rest} == {"only"}
    assert mixing.schedule(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output on the smallest documents and some awkward ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = spark.createDataFrame([(10_000 + i, t, "en", "x", len(t or "")) for i, t in enumerate(AWKWARD)],
                                 docs.schema)
    docs, out = cut(docs.unionAll(more).coalesce(3), "docs"), []
    for name, stage in corpus_pipeline.STAGES:
        new = cut(stage(spark, docs, "/root/testdata/sf0.001"), name)
        out.append((name, docs, new))
        docs = new
    return {n: (a.collect(), b.collect(), a.columns, b.columns) for n, a, b in out}


def test_pipeline_stages(stages):
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, (_, _, before, after) in stages.items():
        assert name == "packing" or after == before
    before, after = stages["quality_rules"][:2]
    kept = {r.doc_id: r for r in after}
    assert all(r == kept[r.doc_id] for r in before if r.doc_id in kept) and 0 < len(kept) < len(before)
    assert all(len(words(r.text)) >= 20 for r in after)
    before, after = stages["line_dedup"][:2]
    before = sorted(before, key=lambda r: r.doc_id)
    want = {r.doc_id: t for r, t in zip(before, brute_lines([r.text for r in before], 3, 40), strict=True) if words(t)}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)
    before, after = stages["near_dedup"][:2]
    before = sorted(before, key=lambda r: r.doc_id)
    classes = brute_classes([r.text for r in before])
    assert sorted(r.doc_id for r in after) == [before[i].doc_id for i in sorted(set(classes))]
    before, after = stages["mixing"][:2]
    assert sorted(before) == sorted(after)
    before, after = stages["packing"][:2]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    from tests.llm.test_texts import check_packed
    totals = Counter()
    for r in after:
        totals[r.doc_id] += r.length
    check_packed(after, list(totals.items()))


def test_sequences_follow_the_mix(spark, tmp_path, monkeypatch):
    """Every prefix of the sequences is near the target weights; stages are written and read as in run()."""
    monkeypatch.setattr(packing.pack_in_order, "__defaults__", (2048, 64, packing.SLACK))
    r = random.Random(11)
    sources = ["long"] * 150 + ["short"] * 1800
    made = [prose(i, r.randint(300, 900) if s == "long" else r.randint(20, 80)) for i, s in enumerate(sources)]
    docs = stored(frame(spark, made, sources=sources), spark, tmp_path)
    assert {"__row", "__place", "a.b"} <= set(docs.columns)
    chosen = mixing.mixed
    weights = spark.createDataFrame([("long", 0.5), ("short", 0.5)], "source string, weight double")
    monkeypatch.setattr(mixing, "mixed", lambda d: chosen(d, weights, block=4000, period=20))
    mixed = cut(corpus_pipeline.mix_sources(spark, docs, SMALL), "mixing")
    assert tables._RECORDED  # what the stage left, which the next one drops
    left = [path for _, path in tables._RECORDED]
    rows = cut(corpus_pipeline.pack(spark, mixed, SMALL), "packing").collect()
    assert not any(os.path.exists(path) for path in left) and mixed.count() == len(made)
    from tests.llm.test_texts import check_packed
    totals = Counter()
    for x in rows:
        totals[x.doc_id] += x.length
    assert set(totals) == set(range(len(made)))
    n = check_packed(rows, list(totals.items()))
    assert n <= 1.03 * sum(totals.values()) / 2048
    in_mix = {x.doc_id for x in mixing.schedule(docs, weights, block=4000, period=20).where("in_mix").collect()}
    end = sum(totals[d] for d in in_mix) * 0.9  # beyond the mix one source goes on alone
    tokens, at = Counter(), -1
    for x in sorted(rows, key=lambda x: x.sequence_id):
        if x.sequence_id != at and 20 * 2048 < sum(tokens.values()) < end:
            assert abs(tokens["long"] / sum(tokens.values()) - 0.5) < 0.12, tokens
        at = x.sequence_id
        tokens[sources[x.doc_id]] += x.length
    assert sum(tokens.values()) > end > 40 * 2048


@pytest.mark.parametrize("stage", ["lines", "substring", "near"])
def test_rows_are_known_when_scans_are_split_anew(spark, tmp_path, monkeypatch, stage):
    """After the first tables are written, files are read in other partitions, as when executors are lost."""
    made = [f"{prose(i % 40, 40)}\n{'l' * 40} {i % 40}\n{prose(1000 + i, 10)}" for i in range(80)]
    docs = stored(frame(spark, made, parts=6), spark, tmp_path)
    run = {"lines": lambda: lines.dedup_lines(docs).select("doc_id", "text", "n_removed"),
           "substring": lambda: substring.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256"),
           "near": lambda: corpus_pipeline.near_dedup(spark, docs, SMALL).select("doc_id", "text")}[stage]
    want = sorted(run().collect())
    key = "spark.sql.files.minPartitionNum"
    module = {"lines": lines, "substring": substring, "near": minhash}[stage]
    last = {"lines": "gone", "substring": "anchors", "near": "classes"}[stage]

    def then_split(df, name):
        out = cut(df, name)
        if name == last:
            spark.conf.set(key, "1")
        return out
    monkeypatch.setattr(module, "cut", then_split)
    try:
        spark.conf.set(key, "64")
        assert sorted(run().collect()) == want
        assert spark.conf.get(key) == "1"
    finally:
        spark.conf.unset(key)


def test_native_operators_run_no_python(spark):
    for name in ("op1_line_dedup", "op8_mixing"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian")), name


def test_held_out_rows_are_never_learnt_from(spark):
    from tradelane.llm.tables import fold
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    import zlib
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in ids.withColumn("f", fold()).collect())
