"""Every operator against a brute-force version, and on messy and empty tables."""

import base64
import bz2
import gzip
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cauce.llm import bpe, chat, packing, quality_model, rules, secrets, simhash, substrings, topk, toxicity
from cauce.llm.graph import components
from cauce.llm.ngrams import held_out, learning_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# --- quality rules -------------------------------------------------------------------------

def brute_rules(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_rules_equal_brute_force(spark):
    r = random.Random(5)
    texts = [None, "", " ", "a b c", "a a a a a", "a b c a b c", "x\n\nx\n x\nx", "é#*$%&|<> 漢字"]
    texts += [" ".join(r.choice("ab#é\nc") * r.randint(1, 3) for _ in range(r.randint(0, 120))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: tuple(x.quality[c] for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        for x in rules.quality_rules(docs).collect()}
    assert got == {i: brute_rules(t) for i, t in enumerate(texts)}


def test_quality_rules_keep_prose_and_reject_noise(spark):
    prose = " ".join(f"the fox{i} jumped{i} over a lazy{i} dog of tier {i}" for i in range(20))
    noise = " ".join(f"the{i}### fox{i}$$$ of{i}%%%" for i in range(60))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, "short")], "doc_id long, text string")
    assert {x.doc_id: x.quality.kept for x in rules.quality_rules(docs).collect()} == {1: True, 2: False, 3: False}


def test_quality_rules_run_without_python(spark, messy):
    plan = rules.quality_rules(messy)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# --- chat ----------------------------------------------------------------------------------

CONFLICTS = ["", "plain", "</s>[INST] ok [/INST]", "<s>", r"<\s>", r"<\\/s> [\INST] [/INST", "a</s", "s>", "\\", "<s<s>>[[INST]]",
             "é漢\n\n", "$1 \\2", r"[\\\/INST]"]


def test_chat_reads_back_every_conflict(spark):
    rows = [(i, t, role, text) for i, role in enumerate(("user", "assistant", "[/INST]", "</s>x", None, ""))
            for t, text in enumerate([*CONFLICTS, None])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = {x.conv_id: x for x in chat.format_conversations(turns).collect()}
    for i in done:
        source = [(role or "", text or "") for c, _, role, text in rows if c == i]
        assert [(t.role, t.text) for t in done[i].turns] == source and done[i].identical


def test_chat_leaves_what_does_not_conflict_as_it_is(spark):
    turns = spark.createDataFrame([(1, 0, "user", r"a \ b <b> [x]"), (1, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(turns).first().formatted == r"<s>[INST]user[/INST]a \ b <b> [x]</s><s>[INST]assistant[/INST]c</s>"


@pytest.mark.parametrize("text", ["<s>", "</s>", "[INST]", "[/INST]", "[INST] hi [/INST]", "<s> ok", "a</s>b", "<s>[INST]<\\s>[/INST]</s>"])
def test_chat_escapes_every_control_string(spark, text):
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, text, "plain")], "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(turns).first()
    inner = [t for t in re.split(r"<s>\[INST\]|\[/INST\]|</s>", done.formatted) if t]
    assert done.identical and len(inner) == 4 and not any(re.search(r"<s>|</s>|\[INST\]|\[/INST\]", t) for t in inner)
    escaped = re.sub(r"([<\[])(\\*)(/?s>|/?INST\])", r"\1\\\2\3", text)
    assert inner == ["user", escaped, escaped, "plain"]


def test_chat_orders_ties_nulls_and_repeats(spark):
    rows = [(None, 1, "b", "y"), (None, 1, "b", "x"), (None, None, "z", "first"), (None, 1, "b", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("written", F.lit(1))
    row = chat.format_conversations(turns).first()
    assert [t.text for t in row.turns] == ["first", "x", "x", "y"] and row.conv_id is None
    assert chat.format_conversations(turns.filter("false")).count() == 0


def brute_topk(rows, k):
    found = []
    for q, v in rows:
        if q % 100 == 0:
            found += [(q, -sum(int(a) * int(b) for a, b in zip(v, w)), c) for c, w in rows if c != q]
    out = []
    for q in {x[0] for x in found}:
        out += [(q, rank, c, -score) for rank, (_, score, c) in enumerate(sorted(x for x in found if x[0] == q)[:k], 1)]
    return sorted(out)


def test_topk_asks_every_row_of_a_query_key(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i % 160, [float(r.randint(-3, 3)) for _ in range(6)]) for i in range(400)] + [(100, [1.0] * 6)] * 2 + [(100, [-2.0] * 6), (300, [0.0] * 6)]
    monkeypatch.setattr(topk, "_blocks", lambda size, made=topk._blocks: made(min(size, 16)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, scale=1).collect()
    assert sorted((x.query_id, x.rank, x.vec_id, x.score) for x in got) == brute_topk(rows, 10)


def test_topk_refuses_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(100, [3e15, 1.0]), (1, [3e15, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        topk.top_k(df, F.col("vec_id") % 100 == 0)


# --- secrets -------------------------------------------------------------------------------

SECRET = "password=hunter2secret99"


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize("hidden", [
    b64(SECRET.encode()), urllib.parse.quote(SECRET, safe=""), "".join(f"%{c:02X}" for c in SECRET.encode()),
    "".join(f"\\u{ord(c):04x}" for c in SECRET), b64(gzip.compress(SECRET.encode())), b64(zlib.compress(SECRET.encode())),
    b64(bz2.compress(SECRET.encode())), b64(lzma.compress(SECRET.encode())), b64(b64(("x " + SECRET).encode()).encode()),
    urllib.parse.quote(b64(gzip.compress(b64(SECRET.encode()).encode())), safe=""),
    base64.urlsafe_b64encode(SECRET.encode()).decode().rstrip("="),
])
def test_secret_is_found_under_every_layer_and_mapped_back(hidden):
    text = f"é漢 before {hidden} after"
    base, more, _ = secrets.scan(text)
    assert not base and any(s.kind == 0 for s, _ in more)
    span = max((s for s, _ in more), key=lambda s: s.end - s.start)
    assert text.index(hidden) <= span.start and span.end <= text.index(hidden) + len(hidden)
    assert span.end - span.start >= len(hidden) - 6


def nested(text, levels):
    for _ in range(levels):
        text = text.replace("%", "%25") if "%" in text else urllib.parse.quote(text, safe="")
    return text


@pytest.mark.parametrize("hidden", [
    nested("password=hunter2 secret", 9), "%2525252541" * 3 + nested("token = abcdef123 é漢", 7),
    "".join(f"\\u{ord(c):04x}" for c in "".join(f"\\u{ord(c):04x}" for c in "".join(f"\\x{ord(c):02x}" for c in "".join(
        f"\\u{{{ord(c):x}}}" for c in "".join(f"%{ord(c):02x}" for c in "secret:abcdef"))))),
    "%2525255cu0070assword=hunter22", "%%%3325%2525" + nested("secret=abcdefg", 5)])
def test_deep_escapes_come_off_as_they_would_level_by_level(hidden, monkeypatch):
    text = f"before {hidden} after"
    _, deep, _ = secrets.scan(text)
    monkeypatch.setattr(secrets, "DEEP", 1000)
    _, level, _ = secrets.scan(text)
    assert {s for s, _ in deep} and {s for s, _ in deep} <= {s for s, _ in level}
    assert max(s.end for s, _ in deep) == max(s.end for s, _ in level)


def test_a_megabyte_of_nested_escapes_ends_in_seconds():
    import time

    begun = time.monotonic()
    _, more, _ = secrets.scan("%" + "25" * 500_000 + "41 password%" + "25" * 100_000 + "3Dhunter2")
    assert time.monotonic() - begun < 30 and any(s.kind == 0 for s, _ in more)


def test_a_run_glued_to_a_letter_is_found():
    for glue in ("k", "ab", "x9z"):
        _, more, _ = secrets.scan(f"{glue}{b64(SECRET.encode())} end")
        assert any(s.kind == 0 for s, _ in more)


def test_a_secret_behind_a_large_layer_with_a_long_run_is_found():
    run = b64(b"\0" * (7 << 20) + b" " + SECRET.encode() + b" ")
    filler = b"all work and no play\n" * (11 << 16)
    _, more, large = secrets.scan(b64(gzip.compress(filler + run.encode())))
    assert large == 0 and any(s.kind == 0 for s, _ in more)


def test_what_cannot_be_scanned_whole_is_redacted_whole(spark):
    before = secrets.LAYER_BYTES
    secrets.LAYER_BYTES = 1000
    try:
        hidden = b64(gzip.compress(b"x y " * 5000))
        assert secrets.scan_layers(f"a {hidden} b")[2] == [(2, 2 + len(hidden))]
    finally:
        secrets.LAYER_BYTES = before
    large = "head " + b64(gzip.compress(bytes(33 << 20))) + " tail"
    docs = spark.createDataFrame([(1, large), (2, large[:200]), (3, None)], "doc_id long, text string")
    assert [x.text for x in secrets.redact_secrets(docs).orderBy("doc_id").collect()] == ["head [secret] tail", large[:200], None]


def brute_secrets(text):
    out = []
    for k, (kind, pattern, flags, group, least) in enumerate((
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
            ("access", "AKIA[A-Z0-9]+", 0, 0, 20), ("hex", "[0-9a-f]+", 0, 0, 24))):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


def test_base_spans_equal_brute_force(spark):
    r = random.Random(2)
    parts = ["password", "Secret", "api_key", "APIKEY", "token", "=", ":", '"', " ", "abc", "abcdef12", "AKIA", "A" * 16, "0f" * 13, "é", "ſecret", "%"]
    texts = [None, "", *("".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.scan_secrets(docs).collect():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in row.secrets if not s.layer] == brute_secrets(texts[row.doc_id])


def test_layers_end_and_large_ones_are_counted(monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    assert secrets.scan(b64(gzip.compress(b"x" * 5000)))[2] == 1
    text = SECRET
    for _ in range(12):
        text = b64(text.encode())
    assert secrets.scan(text)[1][0][1] == ">".join(["base64"] * 12)


def test_redaction_leaves_the_rest(spark):
    rows = [(1, f"a {SECRET} b"), (2, "clean"), (3, None), (4, f"x {b64(SECRET.encode())} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.text for r in secrets.redact_secrets(docs).orderBy("doc_id").collect()] == ["a [secret] b", "clean", None, "x [secret] y"]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_secrets_in_wrapped_base64_are_found(end):
    def wrapped(data):
        return end.join(re.findall(".{1,76}", b64(data)))

    for before in range(57):
        hidden = wrapped(b"." * before + SECRET.encode() + b" and further words of the text" * 3)
        text = f"é before\n{hidden}\nafter"
        base, more, _ = secrets.scan(text)
        assert not base and any(s.kind == 0 for s, _ in more)
        assert text.index(hidden) <= more[0][0].start and more[0][0].end <= text.index(hidden) + len(hidden)
    r = random.Random(1)
    noise = " ".join(str(r.random()) for _ in range(200))
    hidden = wrapped(gzip.compress(f"{noise} {SECRET} {noise}".encode()))
    text = f"before\n{hidden}\nafter"
    (span, path), = secrets.scan(text)[1]
    assert path == "base64>gzip" and text[span.start:span.end].startswith(hidden)
    alone = b64(SECRET.encode())
    (span, _), = secrets.scan(f"{alone}\nafter it")[1]
    assert (span.start, span.end) == (0, len(alone))


@pytest.mark.parametrize("data", [
    f"caf\xe9 {SECRET} ".encode("latin-1"), SECRET.encode("utf-16-le"), f"漢 {SECRET}".encode("utf-16"), f"é {SECRET}".encode("utf-16-be"),
    bytes(range(256)) * 3 + SECRET.encode() + b"\n" + bytes(700), gzip.compress(f"\xff {SECRET}".encode("latin-1")),
])
def test_secrets_in_bytes_that_are_no_utf8_are_found(data):
    text = f"before {b64(data)} after"
    spans = {s for s, _ in secrets.scan(text)[1]}
    assert [7 <= s.start and s.end <= len(text) - 6 for s in spans if s.kind == 0] == [True]


def test_only_invalid_escapes_stay_escaped():
    hidden = "".join(f"%{c:02X}" for c in SECRET.encode())
    for text in (f"%FF{hidden}", f"{hidden}%E9%20end", f"%C3%A9%FF{hidden}%FE"):
        spans = [s for s, _ in secrets.scan(text)[1]]
        assert [text[s.start:s.end] for s in spans] == [hidden]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_large_layers_and_all_members_are_scanned(spark, monkeypatch, pack):
    r = random.Random(3)
    for at in (0, 400, 980, 1490, 4000):
        monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
        noise = "".join(r.choice("., ;") for _ in range(5000))
        data = f"{noise[:at]} {SECRET} {noise[at:]}".encode()
        for hidden in (b64(pack(data)), b64(pack(pack(data)))):
            base, more, large = secrets.scan(hidden)
            assert [s for s, _ in more] == [(0, 0, len(hidden))] and large == 1
    monkeypatch.undo()
    for second in (pack(SECRET.encode()), f" {SECRET}".encode(), bz2.compress(SECRET.encode())):
        hidden = b64(pack(b"first words") + second)
        assert {s.kind for s, _ in secrets.scan(hidden)[1]} == {0}
    docs = spark.createDataFrame([(1, b64(gzip.compress(bytes(33 << 20)))), (2, "clean")], "doc_id long, text string")
    assert [x.secrets_oversized > 0 for x in secrets.scan_secrets(docs).orderBy("doc_id").collect()] == [True, False]


# --- tokens --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_ids_and_texts_equal_the_library(spark, library):
    r = random.Random(1)
    letters = [*"aabbccdeEé'stremvdl  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ²½٣Ⅷ漢́😀<|>_.,-#", " the", "<|endoftext|>", "'ll", "\x00"]
    texts = [None, "", "x" * 900, "abcde" * 300, *("".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(500))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in bpe.encode_texts(docs, decoded="back").collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids and row.back == library.decode(ids, skip_special_tokens=False)
    again = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    assert all(x.decoded == (x.text or "") for x in again)


def test_scanned_and_linked_merges_agree():
    v = bpe.Vocabulary(bpe.default_vocabulary())
    r = random.Random(4)
    for _ in range(200):
        piece = bytes(r.choice(b"abcdehinrst ") for _ in range(r.randint(0, 120)))
        assert v._scan(piece) == v._heap(piece)


def test_a_full_cache_gives_the_same_ids(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE", 3)
    e = bpe.Encoder(bpe.default_vocabulary())
    for text in ("one two three four five six", "six five four three two one") * 3:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


# --- packing -------------------------------------------------------------------------------

def check_packing(rows, sources, library, window):
    pieces, sequences = {}, {}
    for x in rows:
        pieces.setdefault(x.doc_id, []).append(x)
        sequences.setdefault(x.sequence_id, []).append(x)
    assert set(pieces) == set(sources)
    for doc_id, texts in sources.items():
        pool = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
        assert sum(x.length for x in pieces[doc_id]) == sum(map(len, pool))
        for x in pieces[doc_id]:
            assert any(len(ids) == x.doc_tokens and zlib.crc32(np.array(ids[x.start:x.start + x.length], "<u4").tobytes()) == x.ids_crc32 for ids in pool)
        if len(texts) == 1:
            at = 0
            for x in sorted(pieces[doc_id], key=lambda x: x.start):
                assert x.start == at
                at += x.length
    for parts in sequences.values():
        at = 0
        for x in sorted(parts, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= window
    return sequences


def test_packing_holds_every_id_once(spark, library, messy, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 7)
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(["the", "of", "lamp", "river", "stone", f"word{i % 5}"]) for _ in range(r.randint(0, 60)))) for i in range(100, 180)]
    docs = messy.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).coalesce(3)
    sources = {}
    for x in docs.collect():
        sources.setdefault(x.doc_id, []).append(x.text)
    sequences = check_packing(packing.pack_documents(docs, window=64).collect(), sources, library, 64)
    short = [s for s in sequences.values() if sum(x.length for x in s) < 64]
    assert len(short) <= 3


def test_packing_takes_the_nearest_neighbour(spark):
    a, b = "lantern harbour compass", "violin cello orchestra"
    rows = [(1, f"{a} one"), (2, f"{b} two"), (3, f"{b} three"), (4, f"{a} four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = packing.pack_documents(docs, window=16).collect()
    first = min(x.sequence_id for x in found)
    taken = [x.doc_id for x in sorted((x for x in found if x.sequence_id == first), key=lambda x: x.offset)]
    assert set(taken[:2]) in ({1, 4}, {2, 3})


def test_packing_scores_all_terms_of_a_seed():
    size, seed = 200, np.arange(1, 101)
    idf = np.full(size, 1.0, np.float32)
    idf[1:25] = 1.5  # the 24 rarest terms of the seed
    rows = [(1, 100, seed, 0), (2, 100, np.append(seed[:1], np.arange(101, 200)), 0), (3, 100, np.append(seed[24:], np.arange(101, 125)), 0)]
    order, score = packing._Shard(rows, idf, 100.0).ranked(0)
    assert order.tolist() == [0, 2, 1]
    assert np.allclose(score, [24 * 1.5 + 76, 1.5, 76])


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing).count() == 0


def test_related_rests_meet_wherever_they_are_stored(spark, many_slices):
    r = random.Random(6)
    rare = [" ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(12)) for _ in range(150)]
    common = [" ".join(r.choice(("the", "of", "and", "to", "in", "was", "that")) for _ in range(30)) for _ in range(300)]
    rows = [(i, f"{common[i]} {rare[i % 150]} {common[-i]}") for i in range(300)]  # i and i + 150 share their rare words
    for files in (2, 9):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(files, "doc_id")
        got = packing.pack_documents(docs, window=512, shard_docs=16).collect()
        held = {}
        for x in got:
            held.setdefault(x.doc_id, set()).add(x.sequence_id)
        assert sum(bool(held[i] & held[i + 150]) for i in range(150)) >= 0.8 * 150


# --- near-duplicates -----------------------------------------------------------------------

def brute_print(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            for j, q in enumerate(prints):
                if (p ^ q).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_equal_brute_force():
    r = random.Random(7)
    texts = [None, "", " \n", "a", "A b", "x" * 40 + " " + "y" * 70 + " zé É", "a " * 600, "ÀB c\td\x0be\x0cf\rg\x1ch i"]
    texts += [" ".join(r.choice("abcdEFG") * r.randint(1, 30) for _ in range(r.randint(0, 300))) for _ in range(60)]
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == [brute_print(t) for t in texts]


def test_close_pairs_equal_brute_force():
    r = np.random.default_rng(1)
    f = {int(b) ^ sum(1 << int(x) for x in r.choice(64, r.integers(0, 4), replace=False))
         for b in r.integers(0, 2 ** 63, 30) for _ in range(25)}
    f, run = np.array(sorted(f), np.uint64), np.sort(r.integers(0, 3, len(f)))
    for radius in (1, 2, 3):
        got = {(i, j) for a, b in simhash.close_pairs(f, run, radius) for i, j in zip(a.tolist(), b.tolist())}
        assert got == {(i, j) for i in range(len(f)) for j in range(i + 1, len(f))
                       if run[i] == run[j] and (int(f[i]) ^ int(f[j])).bit_count() <= radius}


@pytest.mark.parametrize("piece", [3, 2048])
def test_links_join_what_all_close_pairs_join(spark, piece):
    r = random.Random(3)
    base = [r.getrandbits(63) for _ in range(6)]
    f = list({b ^ sum(1 << x for x in r.sample(range(63), r.randint(0, 4))) for b in base for _ in range(15)} | {0})
    df = spark.createDataFrame([(x,) for x in f], "fingerprint long")
    links = simhash.fingerprint_links(df, piece=piece).collect()
    assert all((x.a ^ x.b).bit_count() <= 3 for x in links)
    label = {x: x for x in f}
    for _ in f:
        for x in links:
            label[x.a] = label[x.b] = min(label[x.a], label[x.b])
    groups = {}
    for x, n in zip(f, brute_components(f)):
        groups.setdefault(n, set()).add(label[x])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_near_duplicates_number_components_by_the_smallest_key(spark, messy):
    found = simhash.near_duplicates(messy).collect()
    assert len(found) == messy.count()
    texts = [(x.doc_id, x.text) for x in messy.select("doc_id", "text").collect()]
    label = brute_components([brute_print(t) for _, t in texts])
    least = {}
    for (k, _), n in zip(texts, label):
        if k is not None:
            least[n] = min(k, least.get(n, k))
    expected = sorted(((k, least.get(n)) for (k, _), n in zip(texts, label)), key=repr)
    assert sorted(((x.doc_id, x.component_id) for x in found), key=repr) == expected


def test_one_row_of_each_group_stays(spark, messy, nothing):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    assert sorted(((x.doc_id, (x.text or "")[:8]) for x in kept.collect()), key=repr) == sorted(
        [(1, "plain wo"), (2, ""), (None, "no key h"), (5, "w0 w1 w2"), (7, "xxxxxxxx")], key=repr)
    assert simhash.keep_one(nothing).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (-3, 100), (200, 7), (7, 200)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: -3 for i in [-3, *range(100, 140)]}, 7: 7, 200: 7}


# --- substring dedup -----------------------------------------------------------------------

def brute_cut(rows, window):
    rank = lambda d: 2 ** 63 if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < rank(d) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 12])
def test_repeats_are_cut_exactly(spark, window):
    r = random.Random(window)
    vocabulary = [*(f"w{i}" for i in range(40)), "é", "Ω"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(window // 2, 3 * window))] for _ in range(10)]
    rows = []
    for _ in range(120):
        w = []
        for _ in range(r.randint(0, 4)):
            p = list(r.choice(passages))
            p = p[r.randint(0, 15):len(p) - r.randint(0, 15)]
            if p and r.random() < 0.3:
                p[r.randrange(len(p))] = f"edit{r.randint(0, 4)}"
            w += p + [r.choice(vocabulary) for _ in range(r.randint(0, 20))]
        rows.append((r.randint(-50, 99) if r.random() < 0.95 else None, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(900, "a " * 400), (901, "a " * 300), (902, "a b " * 200), (903, None), (904, ""), (905, rows[5][1]), (905, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(x.doc_id, x.cut.n_words, x.cut.n_removed, x.cut.text) for x in substrings.cut_repeats(docs, window=window).collect()]
    assert sorted(got, key=repr) == brute_cut(rows, window)


def test_repeats_of_messy_and_empty_tables(messy, nothing):
    rows = [(x.doc_id, x.text) for x in messy.select("doc_id", "text").collect()]
    got = substrings.cut_repeats(messy)
    assert set(messy.columns) < set(got.columns)
    assert sorted(((x.doc_id, x.cut.n_words, x.cut.n_removed, x.cut.text) for x in got.collect()), key=repr) == brute_cut(rows, 50)
    assert substrings.cut_repeats(nothing).count() == 0


def test_substrings_of_very_many_equal_rows_stay_linear(spark):
    r = random.Random(12)
    passage = " ".join(f"p{r.randint(0, 999)}" for _ in range(120))
    rows = [(7, f"own start {passage} own end")] * 1500 + [(3, f"first {passage}"), (9, f"last {passage} of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.cut_repeats(docs).select("doc_id", "cut.n_removed", "cut.text").groupBy("doc_id", "n_removed", "text").count().collect()
    assert sorted(map(tuple, got)) == [(3, 0, f"first {passage}", 1), (7, 120, "own start own end", 1500), (9, 120, "last of all", 1)]


# --- top-k ---------------------------------------------------------------------------------

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 4)
    r = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in r.normal(size=20).round(1)]) for i in range(330)]
    vectors += [(400, vectors[3][1]), (401, vectors[3][1]), (500, None), (600, [float("nan")] * 20), (700, [None] + [1.0] * 19),
                (None, [1.0] * 20), (800, [float("inf")] * 20), (900, [1.0, 2.0]), (901, [3.0, -1.0]), (1000, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit(0)).repartition(3)
    sound = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors
             if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    expected = set()
    for q in (i for i in sound if i % 100 == 0):
        scored = sorted((-int(sound[q] @ v), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:10])}
    got = topk.top_k(df, F.col("vec_id") % 100 == 0).collect()
    assert {tuple(x) for x in got} == expected and len(got) == len(expected)
    assert topk.top_k(df.filter("false"), F.col("vec_id") % 100 == 0).count() == 0


# --- classifiers ---------------------------------------------------------------------------

@pytest.fixture
def labelled(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        toxic, poor = r.random() < 0.3, r.random() < 0.3
        text = [f"w{r.randint(0, 200)}" for _ in range(r.randint(5, 60))]
        if toxic:
            text.insert(r.randint(0, len(text)), r.choice(["Scoundrel!", "villain", "wretch,"]))
        rows.append((i, " ".join(x + ("###" if poor else "") for x in text)))
        labels.append((i, int(not poor), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_never_sees_held_out_labels(labelled):
    docs, labels = labelled
    weights = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, weights).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert len(weights) < 5000 and all(0 <= x.score <= 1 for x in scored)
    assert np.mean([(x.score >= 0.5) == bool(x.toxic) for x in scored]) > 0.9
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_toxicity(docs, turned) == weights
    assert learning_rows(docs, labels, F.col("toxic"), 50).count() == 50


def test_quality_grades_are_ordered(labelled):
    docs, labels = labelled
    model = quality_model.fit_quality(docs, labels, quality_model.rating(F.col("quality"), F.col("toxic")))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    rows = quality_model.score_quality(docs, model, out="grades").join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert all(1 >= x.grades.reaches[0] >= x.grades.reaches[1] >= 0 for x in rows)
    assert all(abs(x.grades.expected_grade - sum(x.grades.reaches)) < 1e-9 for x in rows)
    assert np.mean([(x.grades.reaches[0] >= 0.5) == bool(x.quality) for x in rows]) > 0.9


def test_classifiers_without_labels_and_on_messy_rows(labelled, messy, nothing):
    docs, labels = labelled
    none = toxicity.fit_toxicity(docs, labels.filter("false"))
    assert none == {} and {x.score for x in toxicity.score_toxicity(messy, none).collect()} == {0.0}
    weights = toxicity.fit_toxicity(docs, labels.unionByName(labels.limit(1).withColumn("toxic", F.lit(None).cast("int"))))
    scored = toxicity.score_toxicity(messy, weights).collect()
    assert len(scored) == messy.count() and len({x.score for x in scored if not words(x.text)}) == 1
    assert toxicity.score_toxicity(nothing, weights).count() == 0
    empty = quality_model.fit_quality(docs, labels.filter("false"), F.col("quality"))
    assert empty.weights == {} and {x.quality.expected_grade for x in quality_model.score_quality(messy, empty).collect()} == {None}
    model = quality_model.fit_quality(docs, labels, F.col("quality"), grades=2)
    assert quality_model.score_quality(messy, model).count() == messy.count()


# --- everything on messy rows, and the pipeline --------------------------------------------

@pytest.mark.parametrize("run", [rules.quality_rules, secrets.scan_secrets, secrets.redact_secrets, bpe.encode_texts])
def test_row_operators_keep_rows_and_columns(messy, nothing, run):
    got = run(messy)
    assert set(messy.columns) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    assert {x.words for x in got.collect()} == {"mine"} and got.count() == messy.count()
    assert run(nothing).count() == 0


def test_pipeline_stages_take_effect_one_after_another(spark, library):
    r = random.Random(9)
    prose = lambda n: " ".join("the" if r.random() < 0.2 else f"word{r.randint(0, 9000)}" for _ in range(n))
    shared = prose(70)
    texts = [prose(120), prose(90) + " " + shared, shared + " " + prose(200), "short", prose(100) + " " + SECRET]
    texts += [texts[0], texts[1].upper(), " ".join(f"a{i}$$$" for i in range(80)), None, ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({x.doc_id: x.text for x in docs.collect()})
        assert all(x.n_chars == len(x.text) for x in docs.collect())
    assert set(kept[0]) == {0, 1, 2, 4, 5, 6}
    assert set(kept[1]) == {0, 1, 2, 4}
    assert kept[2][2] == texts[2][len(shared) + 1:] and kept[2][1] == texts[1]
    assert kept[3][4].endswith(" [secret]") and kept[3][0] == texts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    check_packing(packed, {k: [t] for k, t in kept[3].items()}, library, 1024)
    empty = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
