from collections import defaultdict

import numpy as np
import pytest
import xxhash

from twinledger.llm import chunk_dedup
from tests.llm.conftest import prose


def slow_cuts(raw):
    gear, h, ends, at = chunk_dedup.gear_table(), 0, [], 0
    for i, b in enumerate(raw):
        h = (h << 1) + int(gear[b]) & 0xFFFF
        if i + 1 - at > chunk_dedup.MOST:
            at += chunk_dedup.MOST
            ends.append(at)
        if h >> 16 - chunk_dedup.CUT_BITS == 0 and i + 1 - at >= chunk_dedup.LEAST:
            at = i + 1
            ends.append(at)
    return ends + [len(raw)] * (len(raw) > at)


@pytest.mark.parametrize("text", ["", "a", "a" * 1000, prose(500, 1), prose(300, 2).upper(), "日本語" * 200, "x" * 256, "x" * 257])
def test_cuts_equal_the_rolled_hash(text):
    raw = text.encode()
    assert chunk_dedup.cuts(np.frombuffer(raw, np.uint8), chunk_dedup.gear_table()) == slow_cuts(raw)


def slow_spans(rows, least):
    seen = defaultdict(set)
    docs = []
    for i, t, *_ in rows:
        text = t or ""
        raw = text.encode().lower()
        ends = slow_cuts(raw)
        parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
        key = float("inf") if i is None else i
        docs.append((key, text, raw, ends, parts))
        for p in parts:
            seen[p].add(key)
    out = set()
    for key, text, raw, ends, parts in docs:
        runs, starts = [], [0, *ends]
        for k, p in enumerate(parts):
            if len(seen[p]) > 1:
                removed = min(seen[p]) != key
                if runs and runs[-1][1] == k and runs[-1][2] == removed:
                    runs[-1][1] = k + 1
                else:
                    runs.append([k, k + 1, removed])
        for a, b, removed in runs:
            def words(end):
                s = raw[:end]
                return sum(1 for j in range(len(s)) if s[j] not in b"\t\n\x0b\x0c\r " and (j == 0 or s[j - 1] in b"\t\n\x0b\x0c\r "))
            n = words(starts[b]) - words(starts[a])
            if n >= least:
                def chars(end):
                    return sum(x & 0xC0 != 0x80 for x in raw[:end])
                first = min(min(seen[p]) for p in parts[a:b])
                out.add((None if key == float("inf") else key, chars(starts[a]), chars(starts[b]), n, b - a, None if first == float("inf") else first, removed))
    return out


def passages():
    shared, other = prose(60, 50), prose(80, 51)
    rows = [(i, prose(100, 200 + i)) for i in range(12)]
    rows += [(20 + i, prose(40, 300 + i) + " " + shared + " " + prose(30, 400 + i)) for i in range(6)]
    rows += [(40 + i, other + " é " + prose(70, 500 + i)) for i in range(3)] + [(50, prose(90, 600)), (51, prose(90, 600)), (52, prose(90, 600).upper())]
    return rows, shared, other


def test_spans_equal_brute_force(spark, hard, hard_rows):
    rows, *_ = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r)[:7] for r in chunk_dedup.repeated_spans(docs).collect()} == slow_spans(rows, chunk_dedup.SPAN_WORDS)
    small = [r for r in hard_rows if len(r[1] or "") < 5000]
    got = [tuple(r)[:7] for r in chunk_dedup.repeated_spans(hard.filter("text is null or length(text) < 5000"), 3).collect()]
    assert set(got) == slow_spans(small, 3)


def test_shared_passages_are_found_and_clean_documents_left_alone(spark):
    rows, shared, _ = passages()
    spans = chunk_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in spans} == {*range(20, 26), *range(40, 43), 50, 51, 52}
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start: r.end].lower() in texts[r.first_doc_id].lower() for r in spans)
    assert {r.doc_id for r in spans if not r.removed} == {20, 40, 50}


def test_insertion_moves_no_cut_far_behind_it():
    text = prose(400, 7).encode()
    moved = text[:700] + b"inserted" + text[700:]
    gear = chunk_dedup.gear_table()
    one, two = ({raw[a:b] for a, b in zip([0, *c], c)} for raw in (text, moved) for c in [chunk_dedup.cuts(np.frombuffer(raw, np.uint8), gear)])
    assert len(one - two) <= 6


def test_removed_text_occurs_once_and_every_row_stays(spark, hard, hard_rows):
    rows, shared, _ = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(docs).collect()}
    assert {i for i, t in out.items() if t == dict(rows)[i]} == {*range(12), 20, 40, 50}
    middle = " ".join(shared.split()[20:40])
    assert [i for i, t in sorted(out.items()) if middle in t] == [20]
    left = chunk_dedup.remove_repeats(hard)
    assert left.columns == hard.columns and left.count() == len(hard_rows)
    assert chunk_dedup.repeated_spans(chunk_dedup.remove_repeats(docs)).count() == 0


def test_digest_is_of_the_whole_chunk(spark):
    row = chunk_dedup.chunks(spark.createDataFrame([(1, "Short Text")], "doc_id long, text string")).first()
    assert row.digest & (1 << 64) - 1 == xxhash.xxh3_64_intdigest(b"short text") and (row.start, row.end, row.first_word, row.last_word) == (0, 10, 0, 2)


def test_empty_table(none):
    assert chunk_dedup.repeated_spans(none).collect() == [] and chunk_dedup.remove_repeats(none).collect() == []


def test_a_chunk_shared_by_chance_hides_no_passage(spark):
    """Document 2 holds the passage first, but a chunk amid it stays in document 1; no part has enough words alone."""
    passage = prose(36, 51)
    rows = [(1, f"{prose(20, 60)} {' '.join(passage.split()[10:25])} {prose(20, 61)}"), (2, f"{prose(20, 62)} {passage} {prose(20, 63)}"), (3, f"{prose(20, 64)} {passage} {prose(20, 65)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = sorted(chunk_dedup.repeated_spans(docs).collect(), key=lambda r: (r.doc_id, r.start))
    parts = [r for r in spans if r.doc_id == 2]
    assert {r.doc_id for r in spans} == {2, 3} and {r.removed for r in parts} == {True, False}
    assert all(r.n_words < chunk_dedup.SPAN_WORDS for r in parts) and sum(r.n_words for r in parts) >= chunk_dedup.SPAN_WORDS
    assert all(a.end == b.start for a, b in zip(parts, parts[1:]))
    left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(docs).collect()}
    assert left[2] == dict(rows)[2] and len(left[3]) < len(dict(rows)[3])
