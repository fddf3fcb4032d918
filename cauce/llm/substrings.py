"""Substring dedup: passages of 50 words that an earlier document has are cut out, exactly.

1. Each window of 50 words has an anchor, the six-word phrase of least hash in it; equal windows
   have equal anchors. Phrases that are anchors in more than one document recur.
2. The recurring phrases of each slice of documents are compiled into an Aho-Corasick automaton,
   a shard of the dictionary, and the whole texts are streamed through it. Windows whose anchor
   was located are candidates; a run of them with one anchor is a block, known by its hash.
3. The smallest document of every distinct block, and where blocks with one anchor differ, of
   every single window, decides what goes from which document.

Copies share their blocks, so a group of copies costs one block each time, not one window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.registry import query, table
from cauce.llm.words import Words, gram_hashes, mix, slices, sliding
from cauce.sources.scratch import materialise, release

WINDOW, PHRASE = 50, 6
_U = np.uint64
_TOP = _U(0xFFFFFFFFFFFFFFFF)


def _least(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, phrase hashes, the least phrase hash of each window, and which windows lie in one document."""
    h = w.hashes()
    grams = gram_hashes(h, PHRASE)
    least = sliding(grams, window - PHRASE + 1)
    return h, grams, least, w.room(window)[:len(least)]


def _anchors(window: int):
    """Rows ``did, th, h, phrase``: the distinct anchors of each document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = Words(part.column("text"))
            _, grams, least, ok = _least(w, window)
            if not ok.any():
                continue
            room = np.zeros(window - PHRASE, _U)
            most = sliding(np.concatenate([room, np.where(ok, least, _U(0)), room]), window - PHRASE + 1, np.maximum)
            at = np.flatnonzero((grams == most) & (most > 0))
            owner = np.searchsorted(w.doc, at, side="right") - 1
            order = np.lexsort((at, grams[at], owner))
            at, owner = at[order], owner[order]
            new = np.ones(len(at), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (grams[at[1:]] != grams[at[:-1]])
            at, owner = at[new], pa.array(owner[new])
            data = w.data.tobytes()
            phrases = [data[a:b] for a, b in zip(w.start[at].tolist(), w.end[at + PHRASE - 1].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("did").take(owner), part.column("th").take(owner), pa.array(grams[at].view(np.int64)),
                 pa.array(phrases, pa.binary())], ["did", "th", "h", "phrase"])

    return run


def _locate(w: Words, phrases: Iterable[bytes]) -> np.ndarray:
    """For each word, whether one of the phrases starts there. Bytes stand for characters, so places are bytes."""
    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word(" " + p.decode("latin-1") + " ", len(p) + 1)
    found = np.zeros(w.n, bool)
    if not len(automaton):
        return found
    automaton.make_automaton()
    for d in range(w.n_docs):
        if w.doc[d + 1] - w.doc[d] < PHRASE:
            continue
        begin = w.start[w.doc[d]]
        text = " " + w.text(d).decode("latin-1") + " "
        ends = [end - length for end, length in automaton.iter(text)]
        if ends:
            found[np.searchsorted(w.start, begin + np.array(ends))] = True
    return found


def _candidate_blocks(window: int):
    """Rows ``did, th, start, n, anchor, block, windows``: runs of candidate windows with one anchor."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = Words(part.column("text"))
            h, grams, least, ok = _least(w, window)
            if not ok.any():
                continue
            found = _locate(w, set(part.column("phrases").flatten().to_pylist()))[:len(grams)]
            known = sliding(np.where(found, grams, _TOP), window - PHRASE + 1)
            at = np.flatnonzero(ok & (known == least))
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(at)))
            hashes = gram_hashes(h, window)[at]
            place = (np.arange(len(at)) - np.repeat(first, size)).astype(_U)
            block = mix(np.add.reduceat(hashes * (mix(place + _U(1)) | _U(1)), first) + size.astype(_U))
            owner = np.searchsorted(w.doc, at[first], side="right") - 1
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays([
                part.column("did").take(rows), part.column("th").take(rows), pa.array(at[first] - w.doc[owner]),
                pa.array(size), pa.array(least[at[first]].view(np.int64)), pa.array(block.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(hashes.view(np.int64)))],
                ["did", "th", "start", "n", "anchor", "block", "windows"])

    return run


def _cut(kept: list[str], text: str, out: str, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
        for part in slices(batches, text):
            w = Words(part.column(text))
            gone = np.zeros(w.n + 1, np.int64)
            spans = part.column("_spans")
            owner = np.repeat(np.arange(part.num_rows), [len(s) if s else 0 for s in spans.to_pylist()])
            if len(owner):
                flat = spans.flatten()
                base = w.doc[owner]
                np.add.at(gone, base + flat.field("s").to_numpy(), 1)
                np.add.at(gone, base + flat.field("e").to_numpy() + window, -1)
            stay = np.cumsum(gone)[:-1] == 0
            left = np.concatenate([[0], np.cumsum(stay)])
            count = w.counts()
            removed = count - (left[w.doc[1:]] - left[w.doc[:-1]])
            texts = []
            for d in range(part.num_rows):
                if not removed[d]:
                    texts.append(w.text(d).decode())
                    continue
                a, b = w.doc[d], w.doc[d + 1]
                size = w.end[a:b] - w.start[a:b] + 1
                held = w.data[w.start[a]:w.end[b - 1] + 1][np.repeat(stay[a:b], size)]
                texts.append(held[:-1].tobytes().decode())
            result = pa.StructArray.from_arrays([pa.array(count), pa.array(removed), pa.array(texts, pa.string())], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], result], [*kept, out])

    return run


def _spans(keyed: DataFrame, window: int) -> DataFrame:
    """``did, th, spans``: first and last start of the windows to cut from each document."""
    anchors = materialise(keyed.mapInArrow(_anchors(window), "did long, th long, h long, phrase binary"), "anchors")
    # facts of hot keys are written, so that the joins with them are between two plain shuffles, which can be split
    recurring = materialise(anchors.groupBy("h").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).filter("lo < hi").select("h"), "recurring")
    # sets: a row that comes again, with equal key and text, adds nothing
    phrases = materialise(
        anchors.join(recurring, "h").groupBy("did", "th").agg(F.collect_set("phrase").alias("phrases")), "phrases")
    release(anchors)
    release(recurring)
    blocks = materialise(keyed.join(phrases, ["did", "th"]).mapInArrow(
        _candidate_blocks(window),
        "did long, th long, start long, n long, anchor long, block long, windows array<long>"), "blocks")
    release(phrases)
    owners = materialise(blocks.groupBy("anchor", "block").agg(F.min("did").alias("owner")), "owners")
    # all windows of a block go from every document but its smallest
    places = blocks.select("did", "th", "start", "n", "anchor", "block")
    whole = places.join(owners, ["anchor", "block"]).filter("did > owner").select(
        "did", "th", F.col("start").alias("s"), (F.col("start") + F.col("n") - 1).alias("e"))
    # from the smallest, those that a differing block with the same anchor has in a smaller document
    varied = materialise(owners.groupBy("anchor").agg(
        F.min("owner").alias("lo"), F.max("owner").alias("hi")).filter("lo < hi").select("anchor"), "varied")
    first = owners.join(varied, "anchor").select("anchor", "block", F.col("owner").alias("did"))
    single = materialise(blocks.join(first, ["did", "anchor", "block"]).select(
        "did", "th", "start", "anchor", "windows"), "single")
    windows = single.select("did", "th", "start", "anchor", F.posexplode("windows").alias("k", "w"))
    least = materialise(windows.groupBy("anchor", "w").agg(
        F.min("did").alias("lo"), F.max("did").alias("hi")).filter("lo < hi"), "least")
    partly = windows.join(least, ["anchor", "w"]).filter("did > lo").select(
        "did", "th", (F.col("start") + F.col("k")).alias("s"), (F.col("start") + F.col("k")).alias("e"))
    spans = materialise(whole.unionByName(partly).groupBy("did", "th").agg(
        F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    for done in (blocks, owners, varied, single, least):
        release(done)
    return spans


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "cut", window: int = WINDOW) -> DataFrame:
    """Add the struct ``out``: ``n_words``, ``n_removed`` and ``text``, the kept words joined by one space.

    A word goes if a window of ``window`` words that covers it also starts in a document of a
    smaller ``key``; all windows are judged on the input. NULL and empty texts have no words. Rows
    of a NULL key come after all others; rows that share a key do not take words from each other.
    Other columns stay, one named ``out`` is replaced; an empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c != out]
    did = F.coalesce(F.col(key).cast("long"), F.lit(2 ** 63 - 1))
    th = F.xxhash64(F.col(text))
    spans = _spans(docs.select(did.alias("did"), th.alias("th"), F.col(text).alias("text")), window)
    held = docs.select(*kept, did.alias("_did"), th.alias("_th")).join(
        spans.select(F.col("did").alias("_did"), F.col("th").alias("_th"), F.col("spans").alias("_spans")), ["_did", "_th"], "left")
    schema = docs.select(*kept).withColumn(
        out, F.lit(None).cast("struct<n_words: long, n_removed: long, text: string>")).schema
    return held.select(*kept, "_spans").mapInArrow(_cut(kept, text, out, window), schema)


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "cut.n_words", "cut.n_removed", F.sha2(F.col("cut.text"), 256).alias("kept_sha256"))
