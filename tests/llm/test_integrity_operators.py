"""Manifest, alignment and sharding against brute-force versions, and on messy and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cauce.llm import alignment, merkle, sharding
from cauce.llm.bpe import byte_letters

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    clashing = ("gid", "pos", "n", "block", "top", "log", "root", "held", "path", "slice", "docs", "size", "slot", "shard", "place", "_g", "_at")
    return spark.createDataFrame(rows, DOCUMENTS).select("*", *[F.lit("mine").alias(c) for c in clashing])


def messy_rows():
    r = random.Random(3)
    long_text = "long line of words\n" * 60_000
    rows = [(1, "a\nb", "en", "s", 3), (2, None, None, None, None), (3, "", "en", None, 0), (None, "no key", "en", "s", 6), (None, None, None, "", None),
            (4, long_text, "en", "t", len(long_text)), (5, "same\n", "en", "hot", 5), (5, "same\n", "en", "hot", 5), (5, "other", "en", "hot", 5), (2, "é漢▁", "x", "é", 3)]
    return rows + [(i, f"text {r.random()}\n" * r.randint(0, 3), "en", "hot" if i % 3 else f"s{i % 11}", i) for i in range(10, 150)]


# --- manifest ------------------------------------------------------------------------------

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes):
    """All levels of a tree, and the siblings of each leaf level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    siblings = []
    for i in range(len(nodes)):
        steps = []
        for level in levels[:-1]:
            a = i - i % 3
            steps.append((level[a:i], level[i + 1:a + 3]))
            i //= 3
        siblings.append(steps)
    return levels[-1][0], siblings


def brute_manifest(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        said = text.replace("\n", "") if hit and text is not None else text
        groups[source].append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, said)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [climb([x[1] for x in groups[g]]) for g in order]
    root, over = climb([t[0] for t in trees])
    out = []
    for g, (subroot, siblings), above in zip(order, trees, over):
        for (doc_id, leaf, said), steps in zip(groups[g], siblings):
            at = said
            for left, right in steps + above:
                at = digest(*left, at, *right)
            out.append((doc_id, leaf, subroot, root, digest(*[x for l, r in steps + above for x in l + r]), at, at == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("band", [1, 2, 7])
def test_manifest_equals_brute_force_through_several_bands(spark, monkeypatch, many_slices, band):
    monkeypatch.setattr(merkle, "BAND", band)
    rows = messy_rows()
    docs = documents(spark, rows).repartition(5)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    # the workers import the module anew: hand the band over in the closure
    monkeypatch.setattr(merkle, "_build", lambda held, made=merkle._build: _with_band(made(held), band))
    monkeypatch.setattr(merkle, "_read", lambda held, made=merkle._read: _with_band(made(held), band))
    got = merkle.document_proofs(docs, F.coalesce(tampered, F.col("text"))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_manifest(rows)
    assert any(not r.verified for r in got)


def _with_band(run, band):
    def inside(batches):
        from cauce.llm import merkle as module

        before, module.BAND = module.BAND, band
        try:
            yield from run(batches)
        finally:
            module.BAND = before

    return inside


def test_one_leaf_one_source_and_nothing(spark):
    row = (7, "only", "en", "s", 4)
    (got,) = merkle.document_proofs(documents(spark, [row])).collect()
    assert got.leaf == got.subroot == got.root == got.folded_root and got.verified and got.proof_sha256 == digest("")
    assert merkle.document_proofs(documents(spark, [row]).filter("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 80, 100])
def test_log_is_postorder_and_positions_are_closed_form(n):
    leaves = [digest(str(i)) for i in range(n)]
    top = merkle.depth(n)
    log = merkle.build_log(leaves, top)
    assert len(log) == merkle.log_size(n, top)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    for level, nodes in enumerate(levels):
        assert [log[p] for p in merkle.postorder(level, np.arange(len(nodes)), n, top)] == nodes


# --- alignment -----------------------------------------------------------------------------

def brute_alignment(texts):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    docs, counts = [], Counter()
    for text in texts:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_model.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        groups, links, i, j = [], [], 0, 0
        x = y = 0
        ga, gb = [], []
        while i < len(a) or j < len(b):
            if x <= y and i < len(a) and (x < y or not ga):
                ga.append(a[i]); x += len(a_bytes[i]); i += 1
            else:
                gb.append(b[j]); y += len(b_bytes[j]); j += 1
            if x == y and ga and gb:
                groups.append((ga, gb)); links.append((ga[-1], gb[-1])); ga, gb = [], []
        counts.update(links)
        docs.append((len(a), len(b), groups, links))
    most = Counter()
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), digest(text)))
    return out


TEXTS = ["plain words", None, "", " ", "\n\n\t x", "x" * 3000, "é漢字 😀 ﬁ½", "</s> <s> <|endoftext|> <unk>", "has ▁ mark", "\x00\x01", "same text", "same text",
         "l'eau n'est pas", "1234567 12 3", "word " * 4000, "a　b c", "".join(chr(0x300 + i) for i in range(200))]


@pytest.mark.parametrize("limit", [1, 200, 1 << 21])
def test_alignment_equals_brute_force(spark, limit):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ab é漢\n1.") for _ in range(r.randint(0, 60))) for _ in range(60)]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).repartition(3)
    got = {x.doc_id: tuple(x)[1:] for x in alignment.align_tokens(docs, slice_bytes=limit).collect()}
    assert got == dict(enumerate(brute_alignment(texts)))


def test_alignment_groups_cover_all_tokens(spark):
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]).coalesce(2)
    sliced = alignment.aligned_slices(docs)
    facts = {x.doc_id: x for x in alignment.align_tokens(docs).collect()}
    groups = defaultdict(list)
    for g in alignment.groups_of(sliced).collect():
        groups[g.doc_id].append(g)
    for i, fact in facts.items():
        mine = sorted(groups[i], key=lambda g: g.group)
        assert [g.group for g in mine] == list(range(fact.n_groups))
        for side, n in (("a", fact.n_a), ("b", fact.n_b)):
            ends = [g[f"{side}_to"] for g in mine]
            assert [g[f"{side}_from"] for g in mine] == [0, *ends][:len(ends)] and (not ends or ends[-1] == n)
            assert all(len(g[f"{side}_ids"]) == g[f"{side}_to"] - g[f"{side}_from"] for g in mine)


def test_alignment_of_messy_and_no_rows(spark):
    rows = messy_rows()
    docs = documents(spark, rows)
    got = sorted((tuple(x) for x in alignment.align_tokens(docs).collect()), key=repr)
    assert got == sorted(((r[0], *b) for r, b in zip(rows, brute_alignment([r[1] for r in rows]))), key=repr)
    assert alignment.align_tokens(docs.filter("false")).count() == 0


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_gallop_finds_what_both_lists_have(stretch):
    r = np.random.default_rng(0)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 3000), (500, 600), (3000, 3000)):
        a, b = (np.unique(r.integers(0, 4000, k)) for k in (n, m))
        i, j = alignment.gallop(a, b, stretch)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


# --- sharding ------------------------------------------------------------------------------

def check_rows(rows, got, shards):
    size = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((x.doc_id, x["size"], x.text_crc32) for x in got) == size
    held = defaultdict(list)
    for x in got:
        assert 0 <= x.shard < shards
        held[x.shard].append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    loads = [sum(x["size"] for x in got if x.shard == s) for s in range(shards)]
    return loads


def test_shards_weigh_alike_and_places_have_no_gaps(spark):
    r = random.Random(2)
    rows = [(i, "x" * r.randint(0, 900), "en", "s", 0) for i in range(3000)]
    placed, versions = sharding.shard_documents(documents(spark, rows), shards=7, slots=512)
    loads = check_rows(rows, placed.collect(), 7)
    assert max(loads) - min(loads) <= 64
    assert {v.version: v.n for v in versions.groupBy("version").agg(F.count("*").alias("n")).collect()} == {1: 512, 2: 512}


def test_a_key_with_a_third_of_all_rows_is_spread(spark):
    rows = [(5, "same text of every copy", "en", "s", 0)] * 1000 + [(i, f"text {i}", "en", "s", 0) for i in range(2000)]
    placed, _ = sharding.shard_documents(documents(spark, rows), shards=8, slots=256)
    loads = check_rows(rows, placed.collect(), 8)
    assert max(loads) - min(loads) <= 0.01 * sum(loads) / 8


def test_sharding_of_messy_and_no_rows(spark):
    rows = messy_rows()
    placed, _ = sharding.shard_documents(documents(spark, rows), shards=3)
    check_rows(rows, placed.collect(), 3)
    placed, versions = sharding.shard_documents(documents(spark, rows).filter("false"), shards=3)
    assert placed.count() == 0 and versions.count() == 2 * sharding.SLOTS


def test_edits_of_the_map_move_little():
    weight = np.random.default_rng(1).integers(0, 1000, 4096)
    first = sharding.first_map(weight, 40)
    even = sharding.rebalanced(first)
    assert np.ptp(even.loads()) <= 1 and (even.shard != first.shard).mean() < 0.2 and even.version == 2
    more = sharding.grown(even)
    moved = more.shard != even.shard
    assert set(more.shard[moved]) == {40} and more.shards == 41
    assert np.ptp(more.loads()) <= 0.05 * weight.sum() / 41
    assert np.array_equal(sharding.rebalanced(even).shard, even.shard)


def test_a_record_larger_than_a_shard_stays_alone():
    weight = np.array([1000, 10, 10, 10, 10, 0])
    even = sharding.rebalanced(sharding.first_map(weight, 2))
    assert sorted(even.loads()) == [40, 1000]


def test_maps_are_appended_to_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "map")
    first = sharding.first_map(np.arange(8), 2)
    sharding.map_table(spark, [first], path)
    stored = sharding.map_table(spark, [sharding.rebalanced(first)], path)
    assert {(r.version, r.n) for r in stored.groupBy("version").agg(F.count("*").alias("n")).collect()} == {(1, 8), (2, 8)}
