"""Conversation repair, vector codes and suffix dedup against brute force and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from forgeline.llm import conversation_repair as CR
from forgeline.llm import suffix_dedup as SD
from forgeline.llm import vector_codes as VC
from forgeline.llm.queries import queries
from forgeline.llm.shared import ship_package

SF = "/root/testdata/sf0.001"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# -- conversation repair -------------------------------------------------------------

PATTERN = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The contract's damage of (conv_id, turn, role, text) rows, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return out


def every_repair(rows, most=2):
    """(cost, audit, text) of every way to edit the rows, up to ``most`` inserts at a place."""
    fills = [f for n in range(most + 1) for f in itertools.product("ua", repeat=n)]
    names = {"u": "user", "a": "assistant"}
    ways = []
    for (_, role, text), fault in zip(rows, faults(rows)):
        own = [(4, "D", "", [])]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            own.append((extra, "K", role[:1] or "?", [f"{role}:{text}"]))
            own += [(3 + extra, "R", s, [f"{n}:{text}"]) for s, n in names.items()]
        ways.append(own)
    for fill in itertools.product(fills, repeat=len(rows) + 1):
        for edits in itertools.product(*ways):
            cost, audit, initials, lines = 0, "", "", []
            for i in range(len(rows) + 1):
                cost += 3 * len(fill[i])
                audit += "I" * len(fill[i])
                initials += "".join(fill[i])
                lines += [names[s] + ":" for s in fill[i]]
                if i < len(rows):
                    cost, audit, initials = cost + edits[i][0], audit + edits[i][1], initials + edits[i][2]
                    lines = lines + edits[i][3]
            if PATTERN.fullmatch(initials):
                yield cost, audit, "\n".join(lines)


def expected(conv, rows):
    marks = faults(rows)
    turns = [t for t, *_ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, text = min(every_repair(rows))
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations(spark, rows):
    """With extra columns whose names clash with the operator's own."""
    schema = "conv_id long, turn long, role string, text string, gone string, copies string, audit string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)


def test_repair_of_short_conversations_is_the_least_of_all(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Undefined"]
    texts = ["Yes.", "No!", "Well", "  \n", "", None, "Why? \t", "Yes."]
    rows = [(c, rng.choice([0, 1, 1, 2, 5, None]), rng.choice(roles), rng.choice(texts)) for c in range(90) for _ in range(rng.randrange(1, 4))]
    rows += [(None, t, r, x) for t, r, x in [(0, "user", "A."), (None, "system", "B.")]]
    got = sorted(map(tuple, CR.repair_conversations(conversations(spark, rows)).collect()), key=repr)
    short = {c: own for c, own in damaged(rows).items() if len(own) <= 3}
    want = {c: expected(c, own) for c, own in short.items()}
    assert {r[0] for r in got} == set(damaged(rows)) and len(got) == len(damaged(rows))
    assert len(want) > 70
    for r in got:
        if r[0] in want:
            assert r == want[r[0]]


def relaxed(rows):
    """Least (cost, audit, text) by relaxing every edit over and over: no agenda, no order."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}
    best = {(0, ""): (0, "", ())}
    marks = faults(rows)
    changed = True
    while changed:
        changed = False
        for (i, q), (cost, audit, lines) in list(best.items()):
            new = [((i, step[q, s]), (cost + 3, audit + "I", lines + (names[s] + ":",))) for s in "ua" if (q, s) in step]
            if i < len(rows):
                _, role, text = rows[i]
                new.append(((i + 1, q), (cost + 4, audit + "D", lines)))
                if marks[i] in ("sound", "truncated"):
                    extra = 3 * (marks[i] == "truncated")
                    if (q, role[:1]) in step:
                        new.append(((i + 1, step[q, role[:1]]), (cost + extra, audit + "K", lines + (f"{role}:{text}",))))
                    new += [((i + 1, step[q, s]), (cost + 3 + extra, audit + "R", lines + (f"{names[s]}:{text}",))) for s in "ua" if (q, s) in step]
            for k, v in new:
                if k not in best or v < best[k]:
                    best[k], changed = v, True
    cost, audit, lines = min(best[len(rows), q] for q in ("", "a") if (len(rows), q) in best)
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repair_of_the_whole_table(spark):
    got = queries()["op11_conversation_repair"](spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by_conv = damaged(rows)
    assert sorted(r["conv_id"] for r in got) == sorted(by_conv)
    for r in got:
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == relaxed(by_conv[r["conv_id"]])


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_repair_in_chunks_equals_repair_in_one(monkeypatch, chunk):
    monkeypatch.setattr(CR, "CHUNK", chunk)
    monkeypatch.setattr(CR, "SHORT", 0)
    rng = random.Random(chunk)
    for _ in range(40):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "B", "", f"{i}.", f"{i}!"])) for i in range(rng.randrange(0, 24))]
        own = CR.Conversation(7)
        for r in rows:
            own.add(*r)
        assert (own.result()[6:]) == relaxed(rows)


def test_a_long_conversation_is_settled_on_the_way():
    own = CR.Conversation(1)
    for i in range(20_000):
        own.add(i, "assistant" if i % 2 else "user", f"{i}.")
        assert len(own.rows) + len(own.pending) <= 2 * CR.CHUNK
    assert own.result()[6:8] == (0, "K" * 20_000)


def test_agenda_order_and_weights():
    """A goal over two ways of equal cost takes the lesser audit; an item leaves once."""
    ways = [(("x",), "m", 2, "K"), (("x",), "n", 1, "D"), (("n",), "m", 1, "I"), (("m", "y"), "goal", 1, "R")]
    found = CR.lightest_derivations({"x": (0, ""), "y": (0, "")}, ways, {"goal", "m"})
    assert found == {"m": (2, "DI"), "goal": (3, "DIR")}
    assert CR.lightest_derivations({"x": (0, "")}, ways, {"goal"}) == {}  # y is missing


def test_repair_cases(spark):
    # 1:5 is dropped by its key, so the conversation has no rows; dropped keys keep their conversation
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = CR.repair_conversations(conversations(spark, [(1, gone, "user", "Hi.")])).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", EMPTY_HASH)]
    assert CR.repair_conversations(conversations(spark, [])).count() == 0
    plain = next(t for t in range(1000) if zlib.crc32(f"2:{t}".encode()) % 20 > 4)
    long = "word " * 200_000 + "."
    got = CR.repair_conversations(conversations(spark, [(2, plain, "user", long)])).collect()
    assert [(r["cost"], r["audit"]) for r in got] == [(3, "KI")]
    assert got[0]["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:".encode()).hexdigest()


# -- vector codes ----------------------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, label, [int(np.floor(np.float64(x) * 1024)) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = np.array([r[2] for r in kept], np.int64)
    width = x.shape[1] // parts
    cut = [x[:, p * width:(p + 1) * width] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]

    def near(c, b):
        d = ((c[:, None, :] - b[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for c, b in zip(cut, books):
            e, _ = near(c, b)
            for k in range(len(b)):
                if (e == k).any():
                    b[k] = c[e == k].sum(axis=0) // (e == k).sum()
    codes, error = [""] * len(kept), np.zeros(len(kept), np.int64)
    for c, b in zip(cut, books):
        e, d = near(c, b)
        codes = [s + f"{k:02x}" for s, k in zip(codes, e)]
        error += d
    labels = {}
    for (_, label, _), e in zip(kept, error):
        labels[label] = labels.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    return [(i, c, int(e), labels[label], digest) for (i, label, _), c, e in zip(kept, codes, error)]


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x string, code string, part int, error string"
    return spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], schema)


def test_codes_of_the_whole_table(spark):
    got = sorted(map(tuple, queries()["op12_vector_codes"](spark, SF).collect()))
    rows = [(r[0], r[1], r[2]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got == sorted(brute_codes(rows))


def test_codes_with_nulls_ties_and_few_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.125, 3.0, -0.0001]) for _ in range(8)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(300, None, 1), (301, [1.0] * 7 + [None], 1), (302, [float("nan")] * 8, 1), (303, [1.0] * 7 + [float("-inf")], 2)]
    rows += [rows[4], rows[4], (None, rows[9][1], 1)]
    got = sorted(map(tuple, VC.code_report(vectors(spark, rows), entries=32).collect()), key=repr)
    assert got == sorted(brute_codes(rows, entries=32), key=repr)
    few = rows[:5]
    assert sorted(map(tuple, VC.code_report(vectors(spark, few)).collect()), key=repr) == sorted(brute_codes(few), key=repr)


def test_code_cases(spark):
    assert VC.code_report(vectors(spark, [])).count() == 0
    assert VC.code_report(vectors(spark, [(1, None, 1)])).count() == 0
    # lengths that differ, none a multiple of the parts; beyond REACH; no number at all
    got = VC.code_report(vectors(spark, [(1, [1.0, 2.0, 3.0], 1), (2, [1.0] * 5, 1), (3, [1e30] * 5, 2), (4, [], None)])).collect()
    assert sorted((r["vec_id"], r["error"]) for r in got) == [(1, 0), (2, 0), (3, 0), (4, 0)]


@pytest.mark.parametrize("n, width, spread", [(1, 4, 9), (256, 16, 400), (256, 16, 3), (70, 1, 50), (200, 3, 1 << 27)])
def test_slices_find_the_nearest_entry(n, width, spread):
    rng = np.random.default_rng(n + width)
    book, x = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-spread, spread + 1, (3000, width))
    x[:n] = book
    own = VC.SlicedBook(book)
    entry, best = own.nearest(x)
    d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    radius = np.full(len(x), max(1, spread // 2))
    box = (np.abs(x[:, None, :] - book[None]) <= radius[:, None, None]).all(axis=2)
    bits = np.unpackbits(own.in_box(x, radius).view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")[:, :n]
    assert (bits.astype(bool) == box).all()


def test_codes_restore_near_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    codes, books = VC.compress(table)
    back = {r["vec_id"]: r["embedding"] for r in VC.restore(codes, books).collect()}
    error = {r["vec_id"]: r["error"] for r in codes.collect()}
    for r in table.limit(50).collect():
        gap = np.floor(np.array(r["embedding"], np.float64) * 1024) - np.floor(np.array(back[r["vec_id"]]) * 1024)
        assert int((gap ** 2).sum()) == error[r["vec_id"]]


# -- suffix dedup ------------------------------------------------------------------------

def brute_repeats(rows, n=50):
    key = lambda d: (d is None, d or 0)
    rows = [(d, (t or "").encode()) for d, t in rows]
    least, out = {}, []
    for d, t in rows:
        for p in range(len(t) - n + 1):
            least[t[p:p + n]] = min(least.get(t[p:p + n], (True, 1 << 70)), key(d))
    for d, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if least[t[p:p + n]] < key(d):
                gone[p:p + n] = b"\x01" * n
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def text_table(spark, rows):
    return spark.createDataFrame([(*r, "s", "h", 1) for r in rows], "doc_id long, text string, slice string, hashes string, deal int").repartition(5)


SETTINGS = [{}, {"slice_bytes": 2000, "block_bytes": 3000}, {"slice_bytes": 1000, "heavy": 1}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_repeats_of_the_whole_table(spark, settings):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    big = {k: v * 20 if k.endswith("bytes") else v for k, v in settings.items()}
    got = SD.repeat_report(docs, **big) if settings else queries()["op13_suffix_dedup"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("settings", SETTINGS)
def test_repeats_of_made_up_texts(spark, seed, settings):
    rng = random.Random(seed)
    rows = []
    for i in range(110):
        kind = rng.random()
        if kind < 0.3:
            t = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 300)))
        elif kind < 0.6 and rows:
            b = rng.choice(rows)[1] or ""
            a = rng.randrange(0, len(b) + 1)
            t = "x" * rng.randrange(0, 60) + b[a:a + rng.randrange(0, 200)] + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 80)))
        elif kind < 0.8:
            t = rng.choice(["ab", "a", "é"]) * rng.randrange(0, 200)
        elif kind < 0.85:
            t = None
        else:
            t = " ".join(rng.choice(["alpha", "beta", "gamma", "é", "\U0001F600"]) for _ in range(rng.randrange(0, 90)))
        rows.append((rng.choice([i, i, i, None, rng.randrange(0, 110)]), t))
    assert sorted(map(tuple, SD.repeat_report(text_table(spark, rows), **settings).collect()), key=repr) == brute_repeats(rows)


def test_repeat_cases(spark):
    assert SD.repeat_report(text_table(spark, [])).count() == 0
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    rows = [(3, long), (1, long[1_000_000:1_000_200]), (7, long[2_000_000:] + "end"), (7, long[2_000_000:] + "end"), (None, "x" * 49), (None, "x" * 49)]
    got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"]) for r in SD.repeat_report(text_table(spark, rows)).collect()}
    assert got[3, 2_500_000] == (200, 1)
    assert got[1, 200] == (0, 0) and got[7, 500_003] == (500_000, 1) and got[None, 49] == (0, 0)
    one_letter = [(5, "c" * 2_500_000), (4, "c" * 200)]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in SD.repeat_report(text_table(spark, one_letter)).collect()}
    assert got == {5: (2_500_000, 1), 4: (0, 0)}


def test_kept_bytes(spark):
    rows = [(1, "A" + "0123456789" * 6), (2, "<<" + "0123456789" * 6 + ">>é")]
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in SD.remove_repeats(text_table(spark, rows)).collect()}
    assert got == {1: "A" + "0123456789" * 6, 2: "<<>>é"}


@pytest.mark.parametrize("shallow", [0, 8, 24, 48])
def test_deep_shallow_order(shallow):
    rng = random.Random(shallow)
    data = "".join(rng.choice("ab") for _ in range(400)) + "ab" * 100 + "a" * 100 + "".join(rng.choice("ab") for _ in range(100))
    text = np.frombuffer(data.encode() + bytes(58), np.uint8)
    at = np.array(rng.sample(range(len(data) - 50), 500))
    group = np.sort(np.array([rng.randrange(3) for _ in at]))
    order, label = SD.suffix_classes(text, at, group, 50, shallow)
    keys = [(int(group[i]), data[at[i]:at[i] + 50]) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(at)))
    assert [a == b for a, b in zip(keys, keys[1:])] == (label[1:] == label[:-1]).tolist()


def test_blind_trie():
    rng = random.Random(3)
    strings = ["".join(rng.choice("ab") for _ in range(9)).encode() for _ in range(300)]
    trie = SD.BlindTrie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    leaves = list(trie.leaves())
    assert [s for s, _ in leaves] == sorted(set(strings))
    assert all([strings[m] for m in members] == [s] * len(members) for s, members in leaves)


def test_anchors_depend_on_the_string_alone():
    rng = random.Random(4)
    passage = "".join(rng.choice("abc ") for _ in range(300))
    docs = ["".join(rng.choice("abc ") for _ in range(rng.randrange(0, 90))) + passage for _ in range(3)]
    seen = {}
    for block in (64, 1 << 20):
        for d in docs:
            text = np.frombuffer(d.encode(), np.uint8)
            h, anchor, first, last, _ = SD.anchors_of(text, np.array([0, len(text)]), block=block)
            places = [p for f, e in zip(first, last) for p in range(f, e + 1)]
            assert places == list(range(len(d) - 49))  # each string has one anchor
            for x, a, f, e in zip(h, anchor, first, last):
                for p in range(f, e + 1):
                    assert seen.setdefault(d[p:p + 50], (x, a - p)) == (x, a - p)
