import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import Row

from tests.llm.conftest import plain
from twinledger.llm import conversations as C

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """All edits of few rows, tried one by one: (cost, audit, repaired roles and texts)."""
    options = []
    for role, text, fault in rows:
        own = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            own += [(extra, "K", (role, text)), (1 + extra, "R", ("user", text)), (1 + extra, "R", ("assistant", text))]
        options.append(own)
    gaps = [g for n in range(3) for g in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for chosen in itertools.product(*options):
        kept = sum(c[2] is not None for c in chosen)
        if sum(c[0] for c in chosen) > 2 * len(rows):  # dearer than no row at all
            continue
        for put in itertools.product(gaps, repeat=len(rows) + 1) if kept else [((),) * (len(rows) + 1)]:
            new = sum(map(len, put))
            cost = sum(c[0] for c in chosen) + 5 * new
            if cost > 2 * len(rows) or (best and cost > best[0]):
                continue
            audit, result = "I" * len(put[0]), [(r, "") for r in put[0]]
            for (_, edit, row), behind in zip(chosen, put[1:]):
                audit += edit + "I" * len(behind)
                result += ([row] if row else []) + [(r, "") for r in behind]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in result)):
                best = min(best or (cost, audit, result), (cost, audit, result))
    return best


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in damage(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, told = set(), []
        for _, _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            told.append((role, text, fault))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        count = {f: sum(t[2] == f for t in told) for f in ("blank", "duplicate", "truncated")}
        illegal = sum(a[0][:1] + b[0][:1] not in C.LEGAL for a, b in itertools.pairwise(told))
        cost, audit, result = cheapest(told)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in result).encode()).hexdigest()
        out.append((conv, gaps, *count.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_small_conversations_equal_all_edits_tried(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 4)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn * 2, None, turn]), role, rng.choice(["Yes.", "No?", "cut", " \t", "", None, f"Turn {turn}! \n", "a.b"])))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None), (10**15, 7, "user", "x."), (-4, -3, "assistant", "alone.")]
    made = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' as digest", "1 as copies", "2 as kind")
    assert plain(C.repair_damaged(made).collect()) == expected(rows)


def test_one_split_is_as_good_as_all():
    """The doubling spans against textbook CYK, which tries every split of every span."""
    rng = random.Random(2)
    for _ in range(200):
        symbols = [rng.choice("xsuaoSUAO") for _ in range(rng.randrange(1, 9))]
        table = {(i, i + 1): C.terminal(s) for i, s in enumerate(symbols)}
        for length in range(2, len(symbols) + 1):
            for i in range(len(symbols) - length + 1):
                cells = {}
                for k in range(i + 1, i + length):
                    for at, cell in C.join(table[i, k], table[k, i + length]).items():
                        cells[at] = min(cell, cells.get(at, cell))
                table[i, i + length] = cells
        spans = C.Spans()
        for s in symbols:
            spans.add(s)
        assert spans.cells() == table[0, len(symbols)]


def test_a_hot_conversation_passes_several_tasks(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(30_000)] + [(c, 0, "user", "Hi.") for c in range(2, 40)]
    made = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {r.conv_id: r for r in C.repair_damaged(made).collect()}
    told = damage(rows[:30_000])
    assert len(got) == 39 and len(got[1].audit.replace("I", "")) == len(told)
    assert got[1].duplicate == len(told) - len(set(told))
    text, state, at = hashlib.sha256(), 0, 0
    whole, audit = [], got[1].audit
    for edit in audit:
        role = "assistant" if state == 2 else "user"
        if edit == "I":
            whole.append(f"{role}:")
        else:
            row, at = told[at], at + 1
            if edit == "D":
                continue
            whole.append(f"{row[2] if edit == 'K' else role}:{row[3]}")
        state = C.STEP[state, whole[-1][0]]
    text.update("\n".join(whole).encode())
    assert got[1].repaired_sha256 == text.hexdigest()
    facts = C.staged(C._facts(C.damaged(made)), "f")
    parts = facts.repartitionByRange(8, *C._order()).filter("conv_id = 1").selectExpr("spark_partition_id() p").distinct().count()
    assert parts >= 7


def test_repaired_rows_follow_the_grammar_on_the_whole_table(spark, sf_dir):
    rows = C.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    out = C.repaired(rows, C.staged(C.audits(rows), "a")).collect()
    told = {}
    for r in out:
        told.setdefault(r.conv_id, []).append(r)
    for turns in told.values():
        assert [t.place for t in turns] == list(range(len(turns)))
        assert re.fullmatch("s?(ua)+", "".join(t.role[0] for t in turns))


def test_an_empty_table_and_dropped_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_damaged(none).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = C.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert got == [Row(conv_id=gone, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("symbols, audit", [("", ""), ("u", "D"), ("uu", "KR"), ("suaua", "KKKKK"), ("s", "D"), ("xx", "DD"), ("U", "D")])
def test_known_repairs(symbols, audit):
    spans = C.Spans()
    for s in symbols:
        spans.add(s)
    assert C.best(spans.cells())[1] == audit
