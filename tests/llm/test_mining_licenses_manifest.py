"""Hard negatives, license scans and the digest tree against brute force, hashlib and odd tables."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agora.llm import hard_negatives, licenses, merkle
from agora.llm.queries import QUERIES, SQL
from agora.llm.shared import ascii_lower, prepare

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["score", "label", "pos", "n", "tree", "chunk", "leaf", "digest", "key", "grp", "path", "kind", "place", "_row", "labels", "id", "v"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_license_scan", "op13_merkle_manifest"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.select(*sorted(got.columns))) == sorted(want.select(*sorted(got.columns)).fetchall(), key=repr)


# Hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 9), st.sampled_from([1, 3, 64, 1000, 1001, 2500]), st.sampled_from([2, 300, 2**20, 2**31, 2**52, 2**63 - 1]))
def test_residue_products_are_exact(seed, width, most):
    draw = np.random.default_rng(seed)
    a, b = (draw.integers(-most, most, (n, width), np.int64, endpoint=True) for n in (3, 5))
    if seed == 0:
        a[:], b[:] = most, -most
    want = a.astype(object) @ b.T.astype(object)
    assert (hard_negatives.products(a, b) == np.clip(want, -(2**63), 2**63 - 1).astype(np.int64)).all()


def test_sums_of_residues_stay_exact_in_float32():
    assert all(p % 2 for p in hard_negatives.PRIMES) and hard_negatives.PRIMES[0] == 251
    assert hard_negatives.COLUMNS * (max(hard_negatives.PRIMES) // 2) ** 2 + max(hard_negatives.PRIMES) < 2**24
    bound = 2**126 * 4096
    assert len(hard_negatives.primes_for(65536)) == 3 and len(hard_negatives.primes_for(bound)) < len(hard_negatives.PRIMES)


def brute_negatives(rows, anchor, k=5, m=5, low=80, high=100):
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(x * 256)) for x in v])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a, (label, v) in usable.items():
        if not anchor(a):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in usable.items() if i != a]
        for p, positive, _ in sorted(s for s in scores if s[2])[:k]:
            hard = sorted(s for s in scores if not s[2] and low * -p <= 100 * -s[0] <= high * -p)[:m]
            out += [(a, positive, r, n, -p, -s) for r, (s, n, _) in enumerate(hard, 1)]
    return sorted(out)


ODD_VECTORS = [
    (None, 1, [1.0, 2.0]), (10, None, [1.0, 2.0]), (20, 1, None), (30, 1, [float("nan"), 0.0]), (40, 1, [None, 1.0]),
    (50, 1, [float("inf")]), (0, 1, []), (60, 1, [1.0, 0.5]), (60, 1, [1.0, 0.5]), (70, 2, [1.0, 0.25]), (70, 0, [9.0, 9.0]),
    (80, 1, [1.0]), (90, 1, [-1.0, 0.0]), (1, 2, [1.0, 0.5]), (2, 2, [1.0, 0.5]), (3, 3, [0.9, 0.5]), (4, 1, [1.0, 0.5]), (-10, 3, [0.0, 0.0]),
]


@pytest.mark.parametrize("pack", [(hard_negatives.PACK_BYTES, 4096), (1 << 12, 16)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, pack):
    prepare(spark)
    monkeypatch.setattr(hard_negatives, "PACK_BYTES", pack[0])
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", pack[1])
    draw = random.Random(3)
    # Components from few values, so that scores tie often; a hot label.
    rows = ODD_VECTORS + [(i, draw.choice([0, 0, 0, 1, 2]), [draw.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(100, 400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").select("*", *[F.lit("x").alias(c) for c in EXTRA if c != "label"])
    got = rows_of(hard_negatives.mine(df, F.col("id") % 10 == 0))
    assert got == sorted(brute_negatives(rows, lambda i: i % 10 == 0), key=repr)
    assert len({r[0] for r in got}) > 20


def test_hard_negatives_of_an_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(df, F.col("id") % 10 == 0).collect() == []


# License scans

NOTICES = [t for _, t in licenses.TEMPLATES]
FILLER = "lorem ipsum dolor sit amet consectetur the of and to in is for with this software"


def wrapped(text, width=40, mark="# "):
    out, line = [], mark
    for w in text.split():
        if len(line) + len(w) > width:
            out, line = [*out, line], mark
        line += w + " "
    return "\n".join([*out, line])


def license_rows():
    draw = random.Random(5)
    filler = lambda n: " ".join(draw.choice(FILLER.split()) for _ in range(n))
    texts = [None, "", " \n\t", "...", "CC-BY cc by CC\nBY, ccby", "MIT License. mit  LICENSE", "GNU General Public\nLicense", "the gnu public license"]
    for notice in NOTICES:
        texts += [notice, wrapped(notice), f"{filler(700)} {wrapped(notice)} {filler(300)}"]
        # A share of the words around the threshold, in another order.
        words = notice.split()
        for share in (0.7, 0.8, 0.9):
            texts.append(filler(130) + " " + " ".join(draw.sample(words, int(share * len(words)))))
    texts += [filler(5000), "é" * 3000 + " Licensed UNDER the Apache Licence version 2 0 License", "KNU apacheİlicense apache license"]
    texts += [texts[10]] * 3
    return [(i if i % 9 else None, t, None if i % 2 else "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_license_scan_equals_sql_on_hard_cases(spark):
    prepare(spark)
    rows = license_rows()
    df = spark.createDataFrame(rows, DOCS)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = licenses.scan(df.select("*", *[F.lit("x").alias(c) for c in EXTRA]))
    want = con.sql(SQL["op12_license_scan"]).select(*got.columns).fetchall()
    assert rows_of(got) == sorted(want, key=repr)


def test_license_templates_are_found_wherever_they_stand(spark):
    prepare(spark)
    draw = random.Random(7)
    filler = lambda n: " ".join(draw.choice(FILLER.split()) for _ in range(n))
    rows = [(i, f"{filler(draw.randrange(900))} {wrapped(t, draw.randrange(20, 90), '// ')} {filler(draw.randrange(900))}") for i, t in enumerate(NOTICES)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.8
    assert [r["labels"] for r in licenses.scan(spark.createDataFrame([(1, filler(9000))], "doc_id long, text string")).collect()] == [""]


def test_every_template_fits_a_step_and_a_word_order_changes_nothing(spark):
    prepare(spark)
    known = licenses.template_words()
    assert all(len(t.split()) <= licenses.STEP for t in NOTICES)
    df = spark.createDataFrame(license_rows(), DOCS).select(F.monotonically_increasing_id().alias("_row"), licenses.words(F.coalesce("text", F.lit(""))).alias("_words"))
    order = sorted({w for _, ws in known for w in ws})
    assert rows_of(licenses.matches(df, order, known).distinct()) == rows_of(licenses.matches(df, order[::-1], known).distinct())


def test_license_scan_stays_out_of_python(spark):
    prepare(spark)
    plan = licenses.scan(spark.createDataFrame([], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# Digest tree


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def brute_tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def ascii_lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, brute_leaf(row, row[1]), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    top = brute_tree([trees[s][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for i, (_, _, leaf, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
            digest, proof = brute_leaf(row, ascii_lowered(row[1])) if tampered else leaf, []
            for levels, at in ((trees[s], i), (top, number)):
                for level in levels[:-1]:
                    first = at // 16 * 16
                    run = level[first : first + 16]
                    proof += run[: at - first] + run[at - first + 1 :]
                    digest = h(*run[: at - first], digest, *run[at - first + 1 :])
                    at //= 16
            root = top[-1][0]
            out.append((row[0], leaf, trees[s][-1][0], root, h(*proof), digest, digest == root))
    return sorted(out, key=repr)


def manifest_rows(sizes, seed=11):
    draw, rows = random.Random(seed), []
    for s, n in sizes.items():
        rows += [(len(rows) + k, draw.choice(["Some TEXT", "é ÉCOLE A", "", None, "plain"]) , draw.choice(["en", None]), s, k or None) for k in range(n)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2}, {None: 1, "b": 1}, {"a": 17, "b": 16, "é": 15, None: 33, "": 3, "Z": 257}, {"hot": 4200, "cold": 1},
    {f"host {k}": 1 + k % 3 for k in range(300)},
])
def test_manifest_equals_hashlib(spark, sizes):
    prepare(spark)
    rows = manifest_rows(sizes)
    df = spark.createDataFrame(rows, DOCS).repartition(5).select("*", *[F.lit("x").alias(c) for c in EXTRA])
    assert rows_of(merkle.tampered_manifest(df)) == brute_manifest(rows)


def test_manifest_of_repeated_rows_null_keys_and_long_texts(spark):
    prepare(spark)
    rows = [(None, "No Id", None, None, None)] * 3 + [(5, "A" * 300_000, "en", "s", 1)] * 40 + [(5, "B", "en", "s", 1), (None, None, None, "s", None)]
    got = rows_of(merkle.tampered_manifest(spark.createDataFrame(rows, DOCS)))
    assert got == brute_manifest(rows)
    assert merkle.tampered_manifest(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_with_smaller_chunks_is_the_same(spark, levels):
    """Chunks of 16 and 256 leaves make more heights, so paths are joined over several of them."""
    prepare(spark)
    rows = manifest_rows({"hot": 700, "b": 40, **{f"s{k}": 1 for k in range(30)}})
    assert rows_of(merkle.tampered_manifest(spark.createDataFrame(rows, DOCS), levels=levels)) == brute_manifest(rows)


def test_states_are_resumed_with_right_siblings_only(monkeypatch):
    children = [h(str(i)).encode() for i in range(16)]
    parent = merkle.Parent(children)
    seen = []
    real = parent.states[9]

    class Spy:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Spy(self.state.copy())

        def update(self, data):
            seen.append(data)
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    parent.states[9] = Spy(real)
    other = h("other").encode()
    assert parent.fold(9, other) == h(*[c.decode() for c in children[:9]], other.decode(), *[c.decode() for c in children[10:]]).encode()
    assert b"".join(seen) == other + b"".join(children[10:])
    assert parent.fold(9, children[9]) == parent.digest


def test_ascii_lower_leaves_other_letters(spark):
    texts = ["ABC Zz", "ÉCOLE İ K", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(ascii_lower(F.col("t"))).collect()]
    assert got == [None if t is None else ascii_lowered(t) for t in texts]


# Token files and the pipeline


def test_places_are_looked_up_by_shard(spark, monkeypatch):
    from agora.llm import dac
    from agora.llm.vocabularies import default_path

    prepare(spark)
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 40)) for i in range(300)], "doc_id long, text string")
    path = dac.new_path(spark)
    dac.write_ids(docs, path, default_path("word_bpe_49k.json"), 1, shard_ids=500)
    rows = dac.read_ids(spark, path).orderBy("start").collect()
    sequence = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    monkeypatch.setattr(dac, "AT_ONCE", 64)
    asked = [0, 1, 1, len(sequence) - 1, len(sequence), -1, None, *random.Random(4).choices(range(len(sequence)), k=500)]
    places = spark.createDataFrame([(a, "x") for a in asked], "at long, codes string")
    got = rows_of(dac.ids_at(spark, path, places).select("at", "id"))
    want = [(a, int(sequence[a]) if a is not None and 0 <= a < len(sequence) else None) for a in asked]
    assert got == sorted(want, key=repr)


def test_pipeline_dedup_keeps_clashing_names_maps_and_dots(spark):
    import corpus_pipeline

    prepare(spark)
    text = "one two three four five six seven eight"
    rows = [(1, text, 10), (1, text + " nine ten", 20), (2, text, 30), (None, "other words stand here alone today", 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long").select(
        "*", F.create_map(F.lit("k"), F.col("_row")).alias("m"), F.col("_row").alias("a.b"), F.lit("x").alias("doc"))
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(r["_row"] for r in out.collect()) == [10, 20, 40]
    assert all(r["m"] == {"k": r["_row"]} and r["a.b"] == r["_row"] and r["doc"] == "x" for r in out.collect())


# Near-duplicates: word hashes, digests, open groups


def utf8_of(texts):
    import pyarrow as pa

    from agora.llm.shared import utf8

    return utf8(pa.array(texts, pa.string()))


def test_block_hashes_depend_on_the_word_alone():
    from agora.llm import words

    draw = random.Random(8)
    some = sorted({"".join(draw.choices("abé", k=draw.randrange(1, 40))) for _ in range(3000)})
    raw, ends = utf8_of([" ".join(some), " " + "  ".join(some[::-1])])
    starts, stops = words.spans(~words.SPACE[raw], ends)
    h = words.block_hashes(raw, starts, stops)
    assert len(set(h.tolist())) == len(some) and (h[: len(some)] == h[len(some) :][::-1]).all()
    assert len(words.block_hashes(raw[:0], starts[:0], stops[:0])) == 0


def test_words_that_fool_polynomials_stay_apart(spark):
    """Thue-Morse words of 1,024 letters have equal values under every polynomial modulo 2**64."""
    from agora.llm import near_dup

    prepare(spark)
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, word), (2, other), (3, word.upper()), (4, f" {word}\n")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_dup.near_duplicates(df).collect()) == [(1, 1), (2, 2), (3, 1), (4, 1)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB \t\n\x0b.é", max_size=12), max_size=6))
def test_normal_texts(texts):
    import re

    from agora.llm import words

    raw, ends = utf8_of(texts)
    want = [" ".join(re.findall(r"[^\x20\x09-\x0D]+", ascii_lowered(t))).encode() for t in texts]
    assert words.normal_texts(raw, ends) == want


def test_same_set_in_another_order_is_one_component(spark):
    from agora.llm import near_dup

    prepare(spark)
    ring = "a b c d e f g h i j".split()
    once = " ".join(ring + ring[:4])
    turned = " ".join(ring[5:] + ring[:5] + ring[5:9])
    df = spark.createDataFrame([(1, once), (2, turned), (3, "x y z"), (4, "x y z w v u")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df).collect()) == [
        (1, 10, 1), (2, 10, 1), (3, 1, 3), (4, 2, 4)]


def test_open_groups_fetch_sets_of_agreeing_members_only(spark, monkeypatch):
    """Many texts share buckets through one passage but agree with none other: their sets are not moved for the blocks."""
    from agora.llm import near_dup

    prepare(spark)
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    passage = [word() for _ in range(60)]
    texts = [(i, " ".join(passage + [word() for _ in range(60)])) for i in range(150)]
    twin = texts[100][1].split()
    texts.append((500, " ".join(twin[:-1] + [word()])))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    asked = []
    real = near_dup.members_of

    def counted(rows, ids):
        asked.append(sorted({r.doc for r in ids.collect()}))
        return real(rows, ids)

    monkeypatch.setattr(near_dup, "members_of", counted)
    out = near_dup.near_duplicates(df)
    assert {r.doc_id: r.component_id for r in out.collect()} == {**{i: i for i, _ in texts}, 500: 100}
    # The twins are linked in the first pass; hardly any of the 150 others agrees with another one.
    assert len(asked[-1]) < 20


def test_language_training_does_not_grow_with_a_language(spark):
    """Of a language with very many ids only a bounded number is ranked; the sample is the same as ranking all."""
    from agora.llm import language

    prepare(spark)
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    seen = []
    real = language.train
    try:
        language.train = lambda windows, labels, names: seen.append(windows.copy()) or real(windows, labels, names, passes=1)
        language.fit(docs, per_language=50)
        language.SPARE, spare = 10**9, language.SPARE
        language.fit(docs, per_language=50)
    finally:
        language.train, language.SPARE = real, spare
    assert (seen[0] == seen[1]).all() and len(seen[0]) >= 50


# Site templates


def test_templates_of_the_given_pages_go_by_count(spark):
    """Pages of the table as they are: subtrees recur on hosts, and a menu of plain blocks set into each page goes by count alone."""
    from agora.llm import html_text

    prepare(spark)
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    (found,) = html_text.removed(pages).collect()
    assert found.by_count > 1000 and found.by_markup > 0 and found.by_count + found.by_markup < found.blocks
    small = spark.read.parquet(f"{SF}/pages.parquet")
    menu = "<div><div>Start here</div><div>Our partners</div><div>All the letters we got</div></div>"
    with_menu = small.withColumn("html", F.regexp_replace("html", "(?i)(<article[^>]*>)", f"{menu}$1")).withColumn(
        "html", F.regexp_replace("html", "(?i)</?article[^>]*>", ""))
    before = {r.page_id: r.text for r in html_text.extract(small.withColumn("html", F.regexp_replace("html", "(?i)</?article[^>]*>", "")), many=2).collect()}
    after = {r.page_id: r.text for r in html_text.extract(with_menu, many=2).collect()}
    hosts = {r.page_id: r.host for r in small.select("page_id", F.regexp_extract("url", "//([^/]*)", 1).alias("host")).collect()}
    shared = [p for p in hosts if sum(h == hosts[p] for h in hosts.values()) > 2]
    assert len(shared) > 50 and all("Our partners" not in after[p] for p in shared)
    assert sum(after[p] == before[p] for p in shared) > 0.9 * len(shared)
