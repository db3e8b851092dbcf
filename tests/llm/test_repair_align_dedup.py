"""Substring dedup, conversation repair and token alignment against brute force."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from conftest import SF_SMALL
from glossa.llm import conversation_repair as repair
from glossa.llm import substring_dedup as dedup
from glossa.llm import token_alignment as tokens

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()
CLASHING = "doc_id long, text string, block string, bucket int, n_words string, a string, id string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "b", 1, "w", "a", "i") for i, t in rows], CLASHING).repartition(3)


# -- substring dedup ---------------------------------------------------------------------

def _removed(rows, width):
    """Repeats found with a dictionary of all windows; a null id is larger than any."""
    rank = lambda i: float("inf") if i is None else i
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, float("inf")), rank(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < rank(i):
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def _texts(rng, n=150):
    passage = " ".join(f"p{k}" for k in range(60))
    out = []
    for i in range(n):
        words = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 40))]
        if i % 3 == 0:  # near copies: each has one word of its own in the passage
            own = passage.split()
            own[rng.randrange(60)] = f"own{i}"
            words += own
        if i % 5 == 0:
            words += passage.split()
        out.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    return out


@pytest.mark.parametrize("block,bucket", [(400, 300), (1 << 20, 1 << 20)])
def test_substring_dedup_equals_brute_force(spark, block, bucket):
    rng = random.Random(5)
    rows = _texts(rng) + [
        (None, rows_text := " ".join(f"p{k}" for k in range(60))), (None, rows_text), (3, rows_text), (900, ""), (901, None),
        (902, "  \n "), (903, "same " * 5000), (2, "same " * 300), (904, "a\x0bb\x0cc\rd e\x1cf\xa0g　h " * 3),
        (905, "a\x0bb\x0cc\rd e\x1cf\xa0g　h " * 3), (-7, "é ü 😀 " * 9), (906, "é ü 😀 " * 9)]
    got = dedup.remove_repeats(_docs(spark, rows), block_bytes=block, bucket_bytes=bucket)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _removed(rows, 13)


def test_substring_dedup_sends_single_windows_around_hot_minimisers(spark, monkeypatch):
    rows = _texts(random.Random(6), 300)
    monkeypatch.setattr(dedup, "HOT", 0.05)
    blocks = dedup.pack_blocks(_docs(spark, rows), "doc_id", "text", 2000)
    states = dedup.key_states(blocks, 5, 7, 100).collect()
    found = {int(x) for r in states for x in dedup.unpack(r.packed, r.size, r.counts, ["i1"])[0]}
    assert found == {0, 1, 2}
    got = dedup.remove_repeats(_docs(spark, rows), width=5, block_bytes=2000, bucket_bytes=600)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _removed(rows, 5)


def test_substring_dedup_compares_words_when_hashes_meet(spark, monkeypatch):
    rows = _texts(random.Random(7), 40)
    table = dedup.pack_blocks(_docs(spark, rows), "doc_id", "text", 500)
    strings = []
    for b in table.collect():
        cut = dedup.Cut(b.packed, b.size, b.counts, 13)
        units = dedup.Units(cut, dedup.np.ones(len(cut.g_key), int), 1)
        strings += [{"block": b.block, "parts": 0, **s} for s in units.strings()]
    bucket = dedup.pa.Table.from_batches([dedup.record(strings, dedup._ROW)])
    answer = lambda: [r["packed"] for r in dedup._answers(bucket, 13).to_pylist()]
    want, runs = answer(), dedup._runs
    monkeypatch.setattr(dedup, "_runs", lambda v, w: runs(v, w) % dedup.np.uint64(7))
    assert want and answer() == want


def test_substring_dedup_of_nothing(spark):
    assert dedup.remove_repeats(_docs(spark, [])).collect() == []


def test_op11_on_the_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = sorted((i, n, gone, SHA(kept)) for i, n, gone, kept in _removed(docs, 13))
    assert sorted(map(tuple, dedup.op11_substring_dedup(spark, SF_SMALL).collect())) == want
    assert sum(r[2] for r in want) > 1000


# -- conversation repair -------------------------------------------------------------------

NEXT = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def _cheapest(rows):
    """Shortest path over (row, last role); rows are (initial, must go, truncated)."""
    done, heap = {}, [(0, "", 0, "")]
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done[i, last] = cost, audit
        steps = [(3, "I", i, NEXT[r][last]) for r in "ua" if last in NEXT[r]]
        if i < len(rows):
            initial, gone, cut = rows[i]
            steps.append((4, "D", i + 1, last))
            if not gone:
                steps += [(3 * cut, "K", i + 1, NEXT[r][last]) for r in NEXT if r == initial and last in NEXT[r]]
                steps += [(3 + 3 * cut, "R", i + 1, NEXT[r][last]) for r in "ua" if last in NEXT[r]]
        for more, edit, j, role in steps:
            heapq.heappush(heap, (cost + more, audit + edit, j, role))
    return min(done[len(rows), last] for last in ("", "a") if (len(rows), last) in done)


def _read(symbols):
    return [(c.lower(), c == "x", c.isupper()) for c in symbols]


def _all_splits(symbols):
    """The full chart: every span from every one of its splits."""
    n, chart = len(symbols), {}
    for i, s in enumerate(symbols):
        chart[i, i + 1] = repair._ROWS[s]
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells = [repair.combine(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
            assert all(c == cells[0] for c in cells)  # each split gives the same cell
            chart[i, i + size] = cells[0]
    return chart


def test_parse_equals_shortest_paths():
    for n in range(4):
        for symbols in itertools.product(repair.SYMBOLS, repeat=n):
            assert repair.parse("".join(symbols)) == _cheapest(_read(symbols))
    rng = random.Random(3)
    for _ in range(300):
        symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(rng.randint(4, 60)))
        assert repair.parse(symbols) == _cheapest(_read(symbols))
    for _ in range(5):
        _all_splits("".join(rng.choice(repair.SYMBOLS) for _ in range(12)))


def _repaired(table, damaged=True):
    conversations = defaultdict(list)
    text = lambda v: " " if v is None else str(v)
    for c, turn, role, body in table:
        rows, role, body = conversations[c], text(role), text(body)
        kind = zlib.crc32(f"{text(c)}:{text(turn)}".encode()) % 20 if damaged else 19
        body = "" if kind == 1 else re.sub("[.!?]", "", body) if kind == 2 else body
        rows += [(turn, "user" if kind == 4 else role, body)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for c, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, body in rows:
            rest = body.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not rest else "duplicate" if (role, body) in seen
                          else "truncated" if rest[-1] not in ".!?" else "")
            seen.add((role, body))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = _cheapest([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)])
        lines, i, last = [], 0, ""
        for edit in audit:
            if edit != "D":
                role = rows[i][1] if edit == "K" else "assistant" if last == "u" else "user"
                lines.append(f"{role}:{'' if edit == 'I' else rows[i][2]}")
                last = role[0]
            i += edit != "I"
        out[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                  SHA("\n".join(lines)))
    return out


def test_op12_on_the_small_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = {r[0]: tuple(r[1:]) for r in repair.op12_conversation_repair(spark, SF_SMALL).collect()}
    assert got == _repaired(map(tuple, table.collect()))


ODD_TURNS = [(1, None, "user", "First?"), (1, 0, None, "no role."), (1, 2, "tool", "Result."), (1, 9, "assistant", "Yes. \n"),
             (2, 0, "user", None), (2, 1, "user", ""), (2, 1, "user", ""), (None, 5, "system", "A."), (None, 5, "user", "B."),
             (3, 1, "assistant", "Hi."), (3, 1, "assistant", "Hi."), (3, 1, "user", "Hi."), (3, 4, "", "x" * 200_000),
             (4, 1, "system", "a."), (4, 2, "system", "b."), (4, 3, "user", "c"), (5, None, None, None)] + [
    (6, i, "user" if i % 3 else "assistant", f"turn {i}" + "." * (i % 2)) for i in range(400)]


def test_repair_of_odd_rows(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, row int, pos string, symbols string"
    rows = spark.createDataFrame([(*r, 1, "p", "s") for r in ODD_TURNS], schema).repartition(3)
    fixed = repair.repair(rows)
    sha = {r[0]: r[1] for r in repair.digests(fixed.rows).collect()}
    got = {r[0]: (*r[1:], sha.get(r[0], SHA(""))) for r in fixed.conversations.collect()}
    assert got == _repaired(ODD_TURNS, damaged=False)
    path = f"{tmp_path}/conversations.parquet"
    rows.write.parquet(path)
    got = {r[0]: tuple(r[1:]) for r in repair.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == _repaired(ODD_TURNS)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    fixed = repair.repair(none)
    assert fixed.conversations.collect() == fixed.rows.collect() == []


# -- token alignment -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def _aligned(libraries, rows):
    """Every shared end of every text, without anchors or windows."""
    a, b = libraries
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(sorted({*range(256)} - {*own}))}
    count, found = Counter(), []
    for _, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                   for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append(None)
            continue
        ends = {n: j for j, n in enumerate(itertools.accumulate(map(len, bytes_b)))}
        groups, links, i0, j0 = [], [], 0, 0
        for i, n in enumerate(itertools.accumulate(map(len, bytes_a))):
            if n in ends:
                j = ends[n]
                groups.append(",".join(map(str, ids_a[i0:i + 1])) + "|" + ",".join(map(str, ids_b[j0:j + 1])))
                links.append((ids_a[i], ids_b[j]))
                i0, j0 = i + 1, j + 1
        count.update(links)
        found.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted(((i, 0, 0, 0, 0, 0, 0, "") if f is None else
                   (i, f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == best[x[1]] for x in f[3]),
                    sum(count[x] for x in f[3]), SHA(";".join(f[2]))) for (i, _), f in zip(rows, found)), key=repr)


ODD_TEXTS = [(1, None), (2, ""), (3, " "), (4, "a  b   c\n\n d\t<s> <|endoftext|> </s> <unk> <0x41>"), (5, "x▁y"),
             (6, "ﬁ é é 😀👩‍👩‍👧 中文"), (7, " " * 3000 + "z"), (8, "a" * 5000), (9, "\0a\x7f"), (10, "▁"),
             (11, "\r\n x\x85y　z"), (None, "a b"), (4, "a  b   c\n\n d"), (12, "word " * 20_000), (13, "word " * 20_000),
             (14, "don't DON'T 12345 ½ ٣"), (15, "\n" * 2000 + "x"), (16, "tail  ")]


@pytest.mark.parametrize("block,memo", [(50, 3), (1 << 22, 1 << 20)])
def test_alignment_of_odd_texts(spark, libraries, monkeypatch, block, memo):
    monkeypatch.setattr(tokens, "MEMO_WINDOWS", memo)
    blocks = tokens.align(_docs(spark, ODD_TEXTS), block_bytes=block)
    got = sorted((tuple(r) for r in tokens.document_scores(blocks).collect()), key=repr)
    assert got == _aligned(libraries, ODD_TEXTS)


def test_ids_equal_the_library_on_every_code_point(libraries):
    coder = tokens.ByteCoder(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    points = [*range(0xD800), *range(0xE000, 0x110000)][::7]
    texts = [f"a{c}a1{c}1 {c}{c} .{c}. {c}" for c in map(chr, points)]
    want = [e.ids for e in libraries[0].encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert coder.encode(texts) == want


def test_alignment_of_nothing(spark):
    assert tokens.document_scores(tokens.align(_docs(spark, []))).collect() == []


def test_op13_on_the_small_table(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, tokens.op13_token_alignment(spark, SF_SMALL).collect()), key=repr) == _aligned(libraries, docs)
