import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from shiftloom.llm import conversations as c
from shiftloom.llm.texts import table

FULL = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """All cheapest edits by a plain search over (role before) states, the smallest letters on ties."""

    def inserted(best):
        for _ in range(4):
            for before, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    then = NEXT.get((before, role[0]))
                    if then and (new := (cost + 3, audit + "I", out + [(role, "")]))[:2] < best.get(then, (1 << 40, "", []))[:2]:
                        best[then] = new
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        then = {}

        def offer(state, cost, audit, out):
            if (cost, audit) < then.get(state, (1 << 40, ""))[:2]:
                then[state] = (cost, audit, out)

        for before, (cost, audit, out) in inserted(best).items():
            offer(before, cost + 4, audit + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if (before, role[:1]) in NEXT:
                offer(NEXT[before, role[:1]], cost + more, audit + "K", out + [(role, text)])
            for new in ("user", "assistant"):
                if (before, new[0]) in NEXT:
                    offer(NEXT[before, new[0]], cost + 3 + more, audit + "R", out + [(new, text)])
        best = then
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def plain(rows):
    """The report of a table of (conv_id, turn, role, text), stored in this order."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        what = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(turn, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)
    out = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, text in own:
            solid = FULL.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, left = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), left
    return out


@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", " "]), st.integers(0, 3), st.integers(1, 9)), max_size=9))
@settings(max_examples=150, deadline=None)
def test_edits_equal_a_plain_search(parts):
    rows = [(role, fault) for role, fault, count in parts for _ in range(count)]
    marks = "".join(c.symbol(*row) for row in rows)
    audit, cost, state = c.unroll(marks, c.END, 0)
    lines = [(role, "t") for role, _ in rows]
    expected = cheapest([(role, "t", ("", "truncated", "blank", "duplicate")[fault]) for role, fault in rows])
    audit, cost = audit + c.closing(state), cost + c.END[state]
    assert (cost, audit, list(c.edited(audit, lines, 0))) == expected
    assert c.applied(c.matrix(marks), c.END)[0] == cost


@given(st.text(alphabet="suaoSx", max_size=200), st.integers(0, 200))
@settings(max_examples=60, deadline=None)
def test_cut_sequences_have_the_edits_of_the_whole(marks, cut):
    left, right = marks[:cut], marks[cut:]
    one = c.unroll(left, c.applied(c.matrix(right), c.END), 0)
    two = c.unroll(right, c.END, one[2])
    assert (one[0] + two[0], one[1] + two[1], two[2]) == c.unroll(marks, c.END, 0)


def rows_of(found):
    return {r.conv_id: tuple(r)[1:] for r in found.select("conv_id", *c._named(c.REPORT)).collect()}


def test_query_equals_plain_python(spark):
    rows = table(spark, "/root/testdata/sf0.001", "conversations")
    expected = plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert rows_of(c.report(rows)) == {k: v[0] for k, v in expected.items()}


ODD = [
    (None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", None), (1, None, "system", "Be kind."),
    (1, 5, "assistant", " \t"), (1, 5, "user", "What?"), (1, 5, "user", "What?"), (2, 3, "", "x" * 100_000), (2, 3, "Ünï", "文字。"),
    (3, 1, "user", "a\x0b"), (3, 9, "assistant", "b!\n"), (4, None, "tool", "z."), (4, -3, "assistant", "."),
]


@pytest.fixture
def stored_rows(spark, tmp_path):
    def write(rows, schema="conv_id bigint, turn bigint, role string, text string, row string, place string, `at` string"):
        path = str(tmp_path / "conversations")
        spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).coalesce(1).write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_odd_rows_and_a_conversation_over_many_tasks(spark, stored_rows, monkeypatch):
    monkeypatch.setattr(c, "ROWS", 50)
    rng = random.Random(1)
    rows = list(ODD)
    rows += [(50, k // 2, rng.choice(["user", "assistant", "system"]), f"turn {rng.randrange(300)}{rng.choice('.!? ')}") for k in range(1500)]
    rows += [(60 + k, t, rng.choice(["user", "assistant"]), rng.choice(["", "Yes.", "No", "Why?"])) for k in range(200) for t in range(4)]
    docs, expected = stored_rows(rows), plain(rows)
    assert rows_of(c.report(docs)) == {k: v[0] for k, v in expected.items()}
    left = {}
    for r in c.repaired_rows(c.damaged(docs)).orderBy("place").collect():
        left.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    assert left == {k: [(n, *line) for n, line in enumerate(v[1])] for k, v in expected.items() if v[1]}


def test_empty_table_and_dropped_conversations(spark, stored_rows):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    docs = stored_rows([(gone, 1, "user", "Hi.")])
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(c.report(docs)) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert c.report(docs.limit(0)).count() == 0
    assert c.repaired_rows(c.damaged(docs)).count() == 0


def test_text_ids(spark, tmp_path):
    spark.createDataFrame([("b", 1, "user", "Hi."), ("a", 1, "assistant", "No"), (None, 1, "user", "x")],
                          "conv_id string, turn int, role string, text string").write.parquet(str(tmp_path / "t"))
    assert set(rows_of(c.report(spark.read.parquet(str(tmp_path / "t"))))) == {"a", "b", None}
