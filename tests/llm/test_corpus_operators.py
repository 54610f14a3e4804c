"""Chat, near duplicates, mixing, media, sharding, pipeline: SQL, brute force, round trips, odd inputs."""

import hashlib
import random
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL, same_rows
from pyspark.sql import functions as F

from pairwright.llm import chat, jaccard, media, mixing, queries, shards

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 3), (4, "word", None, "a", 4), (4, "word", None, "a", 4), (10, "", None, "b", 1),
    (None, "no id here at all", "en", None, 1), (5, "long text of words " * 20_000, "en", "b", 1), (6, "Größe 😀 it's", "de", "b", 2), (7, "x" * 50_000, "xx", "b", 3), (8, "no id here at all", "en", "c", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    assert same_rows(queries.QUERIES[name](spark, SMALL).toPandas(), duck.sql(queries.ORACLES[name]).df())


# Chat

TREE = "tree string, node long, parent long, role string, text string, score double"


def test_paths_ranks_and_round_trip(spark):
    texts = ["x<|y\\|", "z</s>[INST] [/INST]", "<\\|end|>", "<<SYS>>\\", "[\\\\/INST]", None, "😀<|turn|>\n<|end|>\n"]
    rows = [("a", 1, None, "user", "hi", 0.0), *[("a", i + 2, 1, "assistant", t, float(i)) for i, t in enumerate(texts)], ("a", 20, 3, "user", "ok", 9.0), ("b", 1, 2, "user", "c", 0.0), ("b", 2, 1, "user", "d", 0.0), ("c", 5, 9, "%<\n%0A", "q", None), (None, 1, None, None, None, None)]
    read = {(r.tree, r.leaf): r for r in chat.read_back(chat.format_trees(spark.createDataFrame(rows, TREE))).collect()}
    assert set(read) == {("a", k) for k in (2, 4, 5, 6, 7, 8, 20)} | {("c", 5), ("\0", 1)}
    assert [(t.role, t.text) for t in read["a", 20].turns] == [("user", "hi"), ("assistant", texts[1]), ("user", "ok")]
    for i, t in enumerate(texts):
        if i != 1:
            assert read["a", i + 2].loss == (t or "") and read["a", i + 2].turns[1].text == (t or "")
    assert read["c", 5].turns[0].role == "%<\n%0A"
    for r in read.values():
        assert r.formatted.count("<|turn|>") == len(r.turns) and r.formatted.count("<|end|>") == len(r.turns)
        assert not re.search(r"</?s>|\[/?INST\]|<<SYS>>", r.formatted)
    best = chat.format_trees(spark.createDataFrame(rows, TREE), 1).filter("tree = 'a'").collect()
    assert [r.leaf for r in best] == [20]


def test_deep_and_wide_trees(spark):
    rows = [("deep", i, i - 1 if i else None, "user", str(i), 0.0) for i in range(300)]
    rows += [("wide", i, (i - 1) // 2 if i else None, "user", str(i), 0.0) for i in range(127)]
    paths = {(r.tree, r.leaf): r.path for r in chat.root_paths(spark.createDataFrame(rows, TREE).select("tree", "node", "parent")).collect()}
    assert len(paths) == 1 + 64 and paths["deep", 299] == list(range(300))
    for (tree, leaf), path in paths.items():
        if tree == "wide":
            want = [leaf]
            while want[0]:
                want.insert(0, (want[0] - 1) // 2)
            assert path == want


def test_best_paths_of_random_trees_match_brute_force(spark):
    rng = random.Random(3)
    rows, want, every = [], {}, 0
    for t in range(30):
        size = rng.randint(1, 40)
        parent = [None if i == 0 or rng.random() < 0.1 else rng.randrange(max(0, i - 3), i) for i in range(size)]
        score = [float(rng.randint(0, 5)) for _ in range(size)]
        rows += [(f"t{t}", i, p, "user" if i % 2 else "assistant", f"m{t}.{i}", s) for i, (p, s) in enumerate(zip(parent, score, strict=True))]
        paths = []
        for leaf in set(range(size)) - set(parent):
            path = [leaf]
            while parent[path[0]] is not None:
                path.insert(0, parent[path[0]])
            paths.append((-sum(score[i] for i in path) / len(path), -len(path), leaf, path))
        every += len(paths)
        for k in (1, 2):
            want[f"t{t}", k] = [p[3] for p in sorted(paths)[:k]]
    trees = spark.createDataFrame(rows, TREE)
    assert chat.format_trees(trees).count() == every
    for k in (1, 2):
        got = defaultdict(set)
        for r in chat.read_back(chat.format_trees(trees, k)).collect():
            got[r.tree].add(tuple(int(t.text.split(".")[1]) for t in r.turns))
            assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")
        assert all(got[tree] == set(map(tuple, paths)) for (tree, n), paths in want.items() if n == k)


def test_messages_that_share_a_node(spark):
    rows = [("a", 1, None, "user", "q", 0.0), ("a", 2, 1, "assistant", "y", 1.0), ("a", 2, 1, "assistant", "x", 3.0), ("a", 3, 1, "assistant", "z", 2.0)]
    got = [[t.text for t in r.turns] for r in chat.read_back(chat.format_trees(spark.createDataFrame(rows, TREE), 1)).collect()]
    assert got == [["q", "x", "y"]]


def test_odd_conversations(spark):
    rows = [(1, None, "user", "b", 1), (1, None, "user", "a", 1), (1, 2, "assistant", None, 1), (1, 2, "assistant", None, 1), (None, 1, None, "long " * 50_000, 1)]
    got = {r.tree: r for r in chat.read_back(chat.format_trees(chat.as_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree int")))).collect()}
    assert [(t.role, t.text) for t in got["1"].turns] == [("user", "a"), ("user", "b"), ("assistant", ""), ("assistant", "")]
    assert len(got["\0"].turns[0].text) == 250_000
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_trees(chat.as_trees(nothing)).count() == 0


# Near duplicates


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w) >= 3 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    """rows: (doc_id, text) with distinct ids; size, component and links of each."""
    sets, parent, links = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}, Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 90 * (len(sets[a]) + len(sets[b]) - o):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


def linked(docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.link(docs).collect()}


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        i = rng.randrange(len(words))
        words[i : i + rng.choice([0, 1])] = [f"e{rng.randrange(50)}"]
    return " ".join(words)


@pytest.fixture(scope="module")
def near(spark):
    """Bases with copies of 0 to 8 edits, a common passage, short texts, case and white space variants."""
    rng = random.Random(11)
    common = " ".join(f"c{i}" for i in range(30))
    texts = []
    for n in (3, 5, 12, 40, 41, 120, 300):
        base = [f"w{rng.randrange(4000)}" for _ in range(n)]
        texts += [edited(rng, base, k) for k in range(9) for _ in range(3)]
        texts += [" ".join(base).upper(), "\t".join(base), common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))]
    texts += ["a b", "A  b", "a", "a", "b", "", None, "of the the of the", "of the the of the and"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def test_links_match_brute_force(spark, near):
    assert linked(spark.createDataFrame(near, "doc_id long, text string")) == brute(near)


def test_small_blocks_and_no_broadcast_give_the_same(spark, near, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "MOST_BROADCAST", 0)
    monkeypatch.setattr(jaccard, "COUNTED_WORDS", 50)
    assert linked(spark.createDataFrame(near, "doc_id long, text string")) == brute(near)


def test_blocks_of_few_shingles_give_the_same(spark, near, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 100)
    assert linked(spark.createDataFrame(near, "doc_id long, text string")) == brute(near)


def test_lists_that_may_be_long_give_the_same(spark, near, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_LEVEL", 0)
    assert linked(spark.createDataFrame(near, "doc_id long, text string")) == brute(near)


@pytest.mark.parametrize("block", [1024, 3])
def test_rows_that_share_an_id_keep_their_links(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    a, b, near_a = " ".join(base), " ".join(f"v{i}" for i in range(60)), " ".join([*base, "more"])
    rows = [(5, a), (5, b), (7, near_a), (9, b + " x"), (9, near_a + " y"), (5, a), (None, a), (11, "lone words stand here"), (11, "lone words stand here")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _row int").withColumnRenamed("_row", "row")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard.link(docs).collect()), key=str)
    assert got == sorted([(5, 58, 5, 3), (5, 58, 5, 3), (5, 58, 5, 1), (7, 59, 5, 3), (9, 59, 5, 1), (9, 60, 5, 3), (None, 58, None, 0), (11, 2, 11, 1), (11, 2, 11, 1)], key=str)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_first(docs).collect()]
    assert sorted(kept, key=str) == sorted([(5, a), (5, a), (5, b), (None, a), (11, "lone words stand here"), (11, "lone words stand here")], key=str)


def test_group_filter_loses_no_link():
    rng = random.Random(8)
    table = (np.zeros(0, np.uint64), np.zeros(0, np.uint8))
    for _ in range(150):
        words = [b"w%d" % rng.randrange(10**6) for _ in range(rng.choice([3, 5, 20, 60, 200]))]
        other = edited(rng, [w.decode() for w in words], rng.randint(0, 4)).encode().split()
        for percent, k in ((90, 3), (80, 5)):
            a, b = (set(jaccard.shingle_set(w, k)[0].tolist()) for w in (words, other))
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                (n, _, p, _, s, _), (n2, _, p2, _, s2, _) = (jaccard.prefix_of(w, table, percent, k) for w in (words, other))
                lists = [((1, n, p.tolist().index(x), s), (2, n2, p2.tolist().index(x), s2)) for x in set(p.tolist()) & set(p2.tolist())]
                assert any(jaccard.near_groups([x], [y], percent) == {1: 1, 2: 1} == jaccard.near_groups([x, y], None, percent) for x, y in lists)


def test_short_lists_are_compared_as_long_ones(monkeypatch):
    rng = random.Random(6)
    for _ in range(200):
        m = rng.randint(2, 24)
        base = rng.getrandbits(256)
        flip = lambda: ((base ^ sum(1 << rng.randrange(256) for _ in range(rng.randrange(9)))) % 2**256).to_bytes(32)  # noqa: B023, E731
        members = [(rng.randrange(10**9), rng.randint(20, 40), rng.randint(0, 6), rng.choice([None, *[flip() for _ in range(9)]])) for _ in range(m)]
        cut = rng.choice([None, rng.randint(1, m - 1)])
        sides = (members, None) if cut is None else (members[:cut], members[cut:])
        monkeypatch.setattr(jaccard, "SHORT", 24)
        short = jaccard.near_groups(*sides, 80)
        monkeypatch.setattr(jaccard, "SHORT", 0)
        assert jaccard.near_groups(*sides, 80) == short


@pytest.mark.parametrize(("block", "most"), [(4, None), (1000, 50), (1000, 1), (4, 500)])
def test_any_two_rows_meet_in_one_task(spark, monkeypatch, block, most):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(1)
    rows = [(k, i * 10 + k, rng.randint(1, 60)) for k, size in ((1, 3), (2, 40), (3, 90)) for i in range(size)]
    dealt = jaccard.with_tasks(spark.createDataFrame(rows, "key long, name long, n long"), "key", "name", 80, most).collect()
    tasks = {r.name: {(t.i, t.j): t.side for t in r.tasks} for r in dealt}
    for x in dealt:
        for y in dealt:
            if x.name < y.name and x.key == y.key:
                met = [t for t in tasks[x.name].keys() & tasks[y.name].keys() if t[0] == t[1] or tasks[x.name][t] != tasks[y.name][t]]
                assert len(met) <= 1 and (met or 100 * min(x.n, y.n) < 80 * max(x.n, y.n))


def test_bitmaps_lose_no_link():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.choice([1, 3, 60, 64, 65, 70, 128, 130, 500])
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        drop = rng.randint(0, max(0, n // 9))
        b = np.unique(np.append(a[drop // 2 :], np.array([rng.getrandbits(64) for _ in range(drop - drop // 2)], np.uint64)))
        o = len(np.intersect1d(a, b))
        if len(b) and 100 * o >= 90 * (len(a) + len(b) - o):
            pair = [(1, len(a), jaccard.parity_bitmap(a)), (2, len(b), jaccard.parity_bitmap(b))]
            assert jaccard.near_bitmaps(pair, None, 90) == {1: 1, 2: 1}
            assert jaccard.near_bitmaps(pair[:1], pair[1:], 90) == {1: 1, 2: 1}


def test_odd_documents_link_as_stated(spark, odd, empty):
    rows = jaccard.link(odd).collect()
    assert len(rows) == len(ODD)
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.n_shingles, r.component_id, r.n_links))
    assert got[1] == {(0, 1, 0)} and got[2] == {(0, 2, 0)} and got[10] == {(0, 10, 0)} and got[4] == {(1, 4, 1)} and got[None] == {(3, None, 0)} and got[8] == {(3, 8, 0)}
    assert jaccard.link(empty).count() == 0 and jaccard.keep_first(empty).count() == 0
    assert jaccard.keep_first(odd).columns == odd.columns and jaccard.keep_first(odd).count() == len(ODD)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 4999), (7, 7)]
    got = {r.node: r.component for r in jaccard.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + k: 1000 for k in range(200)}, 5000: 4999, 4999: 4999}


# Mixing


def test_mix_takes_what_targets_ask(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 60), None, rng.choice(["a", "a", "a", "b", "c", None]), i) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("copies", F.lit("mine"))
    found = mixing.weigh(docs).orderBy("doc_id").toPandas()
    assert (found.copies <= 2).all() and found.equals(mixing.weigh(docs).orderBy("doc_id").toPandas())
    by = found.assign(taken=found.copies * found["size"]).groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), size=("source_size", "first"))
    assert (abs(by.taken - by.target) <= 120).all()
    assert by.target.sum() == pytest.approx(1.5 * by["size"].sum()) and (by.target <= 2 * by["size"]).all()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {int(r.doc_id): int(r.copies) for r in found.itertuples() if r.copies}


def test_mix_of_repeated_ids_and_rows(spark):
    rng = random.Random(2)
    rows = [(i % 50, "w " * rng.randint(1, 9), "en", rng.choice("ab"), 1) for i in range(400)] + [(7, "same w", "en", "a", 1)] * 9 + [(None, f"n {i % 3}", "en", "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    weighed = mixing.weigh(docs.withColumn("_digest", mixing.row_digest(docs)), ties=("_digest",))
    want = Counter({r._digest: r.c for r in weighed.groupBy("_digest").agg(F.sum("copies").alias("c")).collect() if r.c})
    mixed = mixing.mix(docs)
    for _ in range(2):
        assert Counter(r._digest for r in mixed.withColumn("_digest", mixing.row_digest(mixed)).collect()) == want


def test_targets_of_many_sources_match_their_sql(spark, duck):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 1, 2, 9, 40]), None, rng.choice([None, *(f"s{k}" for k in range(60)), "s1", "s1", "s1", "Ä", "z"]), 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    con = duck.cursor()
    con.register("d", docs.toPandas())
    con.sql("CREATE TEMP TABLE documents AS SELECT doc_id, text, source FROM d")
    got = mixing.weigh(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies").toPandas()
    assert same_rows(got, con.sql(mixing.OP7_SQL).df())


def test_mix_of_odd_documents(spark, odd, empty):
    assert mixing.mix(empty).count() == 0 and mixing.weigh(empty).count() == 0
    rows = mixing.weigh(odd).collect()
    assert len(rows) == len(ODD) and sum(r.size for r in rows if r.doc_id in (1, 2, 3, 10)) == 0
    assert mixing.mix(odd).count() == sum(r.copies for r in rows)


# Media


def test_media_round_trip(spark, odd, empty):
    rows = media.describe(media.store_media(odd)).collect()
    assert len(rows) == len(ODD)
    want = Counter()
    for doc, text, *_ in ODD:
        raw = (text or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        want[(None if doc is None else str(doc), len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))] += 1
    assert Counter((r.key, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    same = {(r.media_sha256, r.feature) for r in rows if r.key in ("1", "2", "10")}
    assert len(same) == 1
    assert media.describe(media.store_media(empty)).count() == 0


def test_ranges_cover_every_member_once(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), (F.col("id") % 50 + 1).cast("int")).alias("text"))
    manifest = media.write_archives(docs, str(tmp_path), archive_bytes=4000)
    manifest.write.parquet(str(tmp_path / "m"))
    spark.dataSource.register(media.MediaArchives)
    for size in (100, 1500, 10**9):
        got = spark.read.format("media_archive").option("manifest", str(tmp_path / "m")).option("range_bytes", size).load()
        assert sorted(int(r.key) for r in got.select("key").collect()) == list(range(300))


def test_ranges_scale_with_the_archives():
    archives = [(f"a{i}", 1000 + i) for i in range(50)]
    for size, most in ((100, 10_000), (2500, 10_000), (100, 7), (10**9, 3)):
        planned = media.plan_ranges(archives, size, most)
        assert len(planned) <= 2 * most
        pieces = sorted(r for part in planned for r in part)
        assert sum(b - a for _, a, b in pieces) == sum(n for _, n in archives)
        for name, n in archives:
            mine = [(a, b) for x, a, b in pieces if x == name]
            assert mine[0][0] == 0 and mine[-1][1] == n and all(x[1] == y[0] for x, y in zip(mine, mine[1:], strict=False))
    assert media.plan_ranges([], 5) == []


def test_directories_are_read_again(tmp_path, monkeypatch):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("0/1", b"abc")
    whole, fails, real = open(path, "rb").read(), [], media.open_store

    def open_store(p):
        if len(fails) < 2:
            fails.append(1)
            if len(fails) == 1:
                raise OSError("gone")
            open(path, "wb").write(whole[:-30])
        else:
            open(path, "wb").write(whole)
        return real(p)

    monkeypatch.setattr(media, "open_store", open_store)
    assert [i.filename for i in media.read_directory(path)] == ["0/1"]


def test_members_are_read_again_alone(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("0/1", b"abc")
        z.writestr("1/2", b"defg")
    infos = zipfile.ZipFile(path).infolist()

    class Broken:
        def seek(self, at): ...
        def read(self, n):
            raise OSError("gone")

    opened = {"file": Broken()}
    assert media.read_member(path, infos[1], opened) == b"defg" and not isinstance(opened["file"], Broken)
    infos[0].CRC ^= 1
    with pytest.raises(OSError, match="checksum"):
        media.read_member(path, infos[0], {})


# Sharding


def check_shards(rows, shards_=8):
    """rows: pandas with size, shard, slot."""
    assert set(rows.shard) <= set(range(shards_))
    for _, one in rows.groupby("shard"):
        assert sorted(one["slot"]) == list(range(len(one)))


def test_shards_have_near_equal_bytes(spark):
    got = shards.op10_kd_shards(spark, "/root/testdata/sf0.01").toPandas()
    check_shards(got)
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= got["size"].max()
    assert (got.groupby("text_crc32").shard.nunique() == 1).all()


def test_a_hot_group_is_split_and_others_stay_whole(spark):
    rng = random.Random(6)
    rows = [(i, "the same text " * 4, None, None, None) for i in range(4000)] + [(5000 + i, "t" * rng.randint(1, 90) + str(i // 2), None, None, None) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("mine"))
    placed = shards.assign(docs)
    assert placed.columns == [*docs.columns, "shard"]
    got = shards.number(placed).select("doc_id", "text", "shard", "slot").toPandas()
    got["size"] = got.text.str.len() + 1
    check_shards(got)
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 200
    split = got.groupby("text").shard.nunique()
    assert split["the same text " * 4] > 2 and (split.drop("the same text " * 4) > 1).sum() <= 2


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8])
def test_any_number_of_shards(spark, n):
    docs = spark.createDataFrame([(i, "y" * (i % 37), None, None, None) for i in range(400)], DOCS)
    got = shards.number(shards.assign(docs, n)).toPandas()
    check_shards(got, n)
    sums = got.assign(size=got.text.str.len() + 1).groupby("shard")["size"].sum()
    assert len(sums) == n and sums.max() - sums.min() <= 2 * 37 * 11


def reference_tree(rows, dims, leaves, keep):
    """Leaf of every row, the tree grown in memory: rows are (size, group, id, *dims)."""
    span = [max(1, max(r[3 + d] for r in rows) - min(r[3 + d] for r in rows)) for d in range(dims)]
    limit, out = max(max(r[0] for r in rows), sum(r[0] for r in rows) / leaves * keep), {}

    def grow(part, first, n):
        if n == 1 or not part:
            out.update({r[:3]: first for r in part})
            return
        d = max(range(dims), key=lambda i: ((max(r[3 + i] for r in part) - min(r[3 + i] for r in part)) / span[i], -i))
        part = sorted(part, key=lambda r: (r[3 + d], r[1], r[2]))
        goal, upto, at = sum(r[0] for r in part) * (n // 2) / n, 0, 0
        while upto + part[at][0] < goal:
            upto += part[at][0]
            at += 1
        same = [i for i, r in enumerate(part) if (r[3 + d], r[1]) == (part[at][3 + d], part[at][1])]
        if (whole := sum(part[i][0] for i in same)) <= limit:
            below = sum(r[0] for r in part[: same[0]])
            cut = same[-1] + 1 if below + whole - goal <= goal - below else same[0]
        else:
            cut = at + 1 if upto + part[at][0] - goal <= goal - upto else at
        grow(part[:cut], first, n // 2)
        grow(part[cut:], first + n // 2, n - n // 2)

    grow(rows, 0, leaves)
    return out


@pytest.mark.parametrize(("leaves", "levels"), [(8, 4), (8, 1), (13, 2), (3, 4)])
def test_shards_match_a_tree_grown_in_memory(spark, monkeypatch, leaves, levels):
    monkeypatch.setattr(shards, "NEXT_LEVELS", levels)
    rng = random.Random(leaves)
    rows = [(i, rng.choice(["copy of a text ", "ä" * rng.randint(0, 60), "a b c " * rng.randint(1, 30) + str(i)]), rng.choice(["en", "de", None]), rng.choice(["a", "b"]), 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    dims = shards.dimensions(F.col("text")) | {"lang": F.length("lang"), "source": F.ascii("source")}
    facts = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"), F.shiftright(F.xxhash64("text"), 2).alias("g"), F.shiftright(F.xxhash64(F.col("doc_id").cast("string")), 2).alias("i"), *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in dims.items()]).collect()
    want = reference_tree([tuple(r[1:]) for r in facts], len(dims), leaves, shards.KEEP_WHOLE)
    got = {r.doc_id: r.shard for r in shards.assign(docs, leaves, dims).collect()}
    assert got == {r.doc_id: want[tuple(r[1:4])] for r in facts}


def test_target_bytes_set_the_leaves(spark):
    docs = spark.createDataFrame([(i, "y" * 99, None, None, None) for i in range(640)], DOCS)
    got = shards.assign(docs, target_bytes=6400).groupBy("shard").count().collect()
    assert len(got) == 10 and {r["count"] for r in got} == {64}
    with pytest.raises(ValueError):
        shards.assign(docs, 8, target_bytes=10)


def test_columns_named_as_the_results_pass_through(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "mine", i * 2) for i in range(40)], "doc_id long, text string, shard string, Slot long")
    got = shards.number(shards.assign(docs, 4))
    assert got.columns == ["doc_id", "text", "shard", "Slot", "shard_", "slot_"]
    rows = got.collect()
    assert len(rows) == 40 and all(r["shard"] == "mine" and r["Slot"] == 2 * r.doc_id for r in rows) and {r["shard_"] for r in rows} == {0, 1, 2, 3}
    assert mixing.mix(docs.withColumn("source", F.lit("a"))).columns == [*docs.columns, "source"]


def test_shards_of_odd_documents(spark, odd, empty):
    assert shards.number(shards.assign(empty)).count() == 0
    got = shards.number(shards.assign(odd)).toPandas()
    assert len(got) == len(ODD)
    check_shards(got)
    with pytest.raises(ValueError):
        shards.assign(odd, 0)


# Pipeline


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("bitmap", F.lit(1))
    columns, seen = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == columns
        now = {r.doc_id for r in out.collect()}
        assert now and now <= seen
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            assert sum(labels[d] for d in labels if d not in now) <= 2 and sum(1 for d, q in labels.items() if q == 0 and d in now) <= 2
        elif name == "near_duplicates":
            want = brute([(r.doc_id, r.text) for r in docs.collect()])
            assert now == {d for d, (_, component, _) in want.items() if d == component}
        elif name == "decontaminate":
            from pairwright.llm.decontam import find_leaks

            assert seen - now == {r.doc_id for r in find_leaks(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
        docs, seen = spark.createDataFrame(out.collect(), out.schema), now
    last = pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.columns == [*columns, "shard", "slot"] and last.count() == docs.count()


def test_near_duplicate_stage_links_five_words_at_80_percent(spark, near):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = near + [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    five = lambda w: frozenset(zip(*(w[i:] for i in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    sets, first = {i: five(cut(t)) for i, t in rows}, {i: i for i, _ in rows}
    for _ in rows:  # the smallest id that is reached, until nothing moves
        before = dict(first)
        for a in sets:
            for b in sets:
                o = len(sets[a] & sets[b])
                if o and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                    first[a] = min(first[a], first[b])
        if first == before:
            break
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in pipeline.near_duplicates(spark, docs, SMALL).collect()}
    assert kept == {i for i in first if first[i] == i}
    assert len(kept) < jaccard.keep_first(docs).count()


def test_pipeline_run_gives_the_columns(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    got = pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"] and got.count() > 100
