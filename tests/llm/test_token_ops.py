"""Fill-in-middle, token files and the turn trie against plain re-computations."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_helpers import EDGE, documents, prose  # noqa: E402

from tokenizers import Tokenizer  # noqa: E402

from framewise.llm import fill_middle, queries, radix_tree, rans, token_files, turn_trie  # noqa: E402

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(key, text):
    text = text or ""
    units = UNIT.findall(text)
    h = [int(sha(f"42:{'' if key is None else key}")[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return key, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return key, len(units), form, len(p), len(m), sha(out), sha(text)


def odd_text(r):
    alphabet = "ab é日😀\u0085  \x1c\x0b\t\n\r\x0c  <PSM>́\x00"
    return "".join(r.choice(alphabet) for _ in range(r.randrange(60)))


def test_fim_equals_plain_form_on_odd_texts(spark):
    r = random.Random(3)
    rows = [(i, odd_text(r)) for i in range(600)] + EDGE + [
        (900, "a <P> b"), (901, "x" * 8), (902, "x" * 7 + " "), (903, " " * 16), (904, "< P>" * 50), (905, "a<S"),
        (-1, prose(9, 50))] + [(906, prose(10, 300))] * 300
    got = fill_middle.digests(fill_middle.transform(documents(spark, rows)))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_fim(*row) for row in rows), key=key)


def test_fim_empty_table_and_own_columns(spark):
    docs = documents(spark, [])
    assert fill_middle.transform(docs).count() == 0
    other = spark.createDataFrame([("k1", "one two three", 1)], "id string, body string, output int")
    out = fill_middle.transform(other, text="body", key="id", rate=100, spm=0)
    row = out.select("id", "form", fill_middle.restore(out["output"], out["form"]).alias("t")).first()
    assert tuple(row) == ("k1", "psm", "one two three")


def test_unit_index_cuts_at_every_unit():
    texts = [b"", b" ", b"a", b"abc def  ghi ", b"12345678", b"1234567 9", "é😀 日本 x".encode() * 40]
    index = fill_middle.UnitIndex(texts)
    for i, t in enumerate(texts):
        units = re.findall(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
        assert index.n[i] == len(units)
        for k in range(len(units) + 1):
            want = np.zeros(len(texts), np.int64)
            want[i] = k
            size = index.cut(want)
            assert size[i] == len(b"".join(units[:k]))
            assert index.code_points(size)[i] == len(t[:size[i]].decode())


WORD_FILE = Path(queries.WORDS)


def plain_tokens(rows, end=2):
    tok = Tokenizer.from_file(str(WORD_FILE))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    out, start = [], 0
    for key, text in ordered:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_the_library_on_odd_texts(spark):
    r = random.Random(5)
    rows = [(r.randrange(10**9), odd_text(r)) for _ in range(500)] + EDGE + [
        (20, "Straße, DON'T stop!! a<|endoftext|>b <|startoftext|> x"), (21, "İstanbul Ünï co.de's 12,5; é ΑΣ"),
        (22, prose(3, 60_000)), (23, "x" * 5000)] + [(24, prose(12, 30))] * 400
    got = token_files.documents(token_files.write(documents(spark, rows), WORD_FILE.read_text()))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda x: x[1]) == plain_tokens(rows)
    assert max(x[2] for x in plain_tokens(rows)) > 2 * rans.BLOCK  # one document spans blocks


def test_token_files_of_empty_table_and_without_end(spark):
    assert token_files.documents(token_files.write(documents(spark, []), WORD_FILE.read_text())).count() == 0
    files = token_files.write(documents(spark, [(3, ""), (1, None)]), WORD_FILE.read_text(), end=None)
    assert [tuple(r) for r in token_files.documents(files).orderBy("doc_id").collect()] == [(1, 0, 0, 0), (3, 0, 0, 0)]


def test_token_files_can_be_opened_later_and_ids_read(spark):
    rows = [(i, prose(i, 50)) for i in range(40)]
    path = token_files.write(documents(spark, rows), WORD_FILE.read_text()).path
    tok = Tokenizer.from_file(str(WORD_FILE))
    for r in token_files.pieces(token_files.open_files(spark, path)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == tok.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [2]


@pytest.fixture
def one_file(tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 1024)
    monkeypatch.setattr(rans, "STEPS", 4)
    monkeypatch.setattr(token_files, "BATCH", 3)
    r = np.random.default_rng(1)
    docs = [(i if i % 7 else None, r.zipf(1.3, n).clip(max=70_000).astype("<u4")) for i, n in
            enumerate([0, 1, 1024, 1023, 5, 0, 6000, 2048, 0, 3])]
    ids, counts = np.unique(np.concatenate([d for _, d in docs]), return_counts=True)
    table = rans.Table.of_counts(ids, counts)
    writer = token_files.FileWriter(str(tmp_path / "a.tokens"), table)
    for key, own in docs:
        writer.add(key, own)
    writer.close()
    return docs, table, tmp_path / "a.tokens"


def read_file(path, table, runs_of=3):
    index = token_files.read_index(str(path))
    raw = path.read_bytes()
    for i in range(0, len(index), runs_of):
        some = index[i: i + runs_of]
        at = int(some["at"][0])
        yield from token_files.read_blocks(raw[at: at + int(some["size"].sum())], some["crc"].tolist(), table)


@pytest.mark.parametrize("runs_of", [1, 2, 3, 100])
def test_blocks_decode_alone_and_together(one_file, runs_of):
    docs, table, path = one_file
    table = rans.Table.from_bytes(table.to_bytes())
    seen = {}
    for block, ids in read_file(path, table, runs_of):
        at = 0
        for i, p in enumerate(block.pieces):
            key = None if p["null"] else int(p["doc_id"])
            seen.setdefault(block.ordinal + i, (key, []))[1].extend(ids[at: at + p["n"]].tolist())
            at += p["n"]
        assert at == len(ids) == block.fill
    assert [seen[i] for i in range(len(docs))] == [(k, d.tolist()) for k, d in docs]


def test_damage_is_found(one_file):
    docs, table, path = one_file
    raw = bytearray(path.read_bytes())
    index = token_files.read_index(str(path))
    raw[int(index["at"][1]) + int(index["size"][1]) - 2] ^= 1
    path.write_bytes(raw)
    with pytest.raises(ValueError, match="damaged block"):
        list(read_file(path, table))
    raw[-30] ^= 1
    path.write_bytes(raw)
    with pytest.raises(ValueError, match="damaged index"):
        token_files.read_index(str(path))


def test_coded_size_is_near_the_entropy():
    r = np.random.default_rng(2)
    ids = r.zipf(1.5, rans.BLOCK).clip(max=49_000)
    kinds, counts = np.unique(ids, return_counts=True)
    table = rans.Table.of_counts(kinds, counts)
    words, places, states = table.encode(ids[None, :])
    entropy = -(counts * np.log2(counts / counts.sum())).sum() / 8
    assert 4 * len(words[0]) < 1.02 * entropy + 8 * rans.LANES
    assert len(places[0]) == rans.BLOCK // rans.LANES // rans.STEPS == len(states[0])


def test_joined_crc():
    r = random.Random(1)
    for n, m in [(0, 0), (1, 0), (0, 5), (3, 1), (1000, 777)]:
        a, b = r.randbytes(n), r.randbytes(m)
        assert rans.joined_crc(zlib.crc32(a), zlib.crc32(b), m) == zlib.crc32(a + b)


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + ts[h:]
    members, ends = {}, {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    below = {n: [0, 0, 0] for n in members}
    for n in members:
        leaf = not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members)
        saved = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            below[n[:d]][1] += leaf
            below[n[:d]][2] += saved
        if n:
            below[n[:-1]][0] += 1
    return sorted((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), *below[n],
                   sha(",".join(map(str, sorted(ends.get(n, [])))))) for n, cs in members.items())


TURN_SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, s string"


def trie_of(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], TURN_SCHEMA)
    got = turn_trie.conversation_trie(docs)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, got.collect()))


def test_trie_equals_plain_sets(spark):
    r = random.Random(8)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "é", "", None]))
            for c in range(-30, 120) if c % 11 for t in range(r.randrange(1, 20))]
    rows += [(7, 3, "user", "a")] * 5 + [(None, 0, "user", "x"), (200, None, "user", "first"), (200, None, "user", "first")]
    rows += [(1000 + c, t, "user", str(t)) for c in range(60) for t in range(20)]  # copies of one conversation
    rows += [(2001, t % 7, "user", "again") for t in range(2500)]  # a long one of repeated turns
    r.shuffle(rows)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    assert trie_of(spark, []) == [] == trie_of(spark, [(None, 1, "user", "x")])
    short = [(c, 0, "user", "x") for c in (6, 7, 8, 9) if zlib.crc32(str(c).encode()) % 9]
    assert trie_of(spark, short) == plain_trie(short) and plain_trie(short)[0][3] == len(short)


def test_radix_tree_totals_at_aligned_depths():
    tree = radix_tree.RadixTree(lambda a, b: a + b)
    r = random.Random(4)
    keys = [bytes(r.choice(b"ab") for _ in range(4 * r.randrange(5))) for _ in range(500)]
    keys += [bytes([b, c]) * 2 for b in range(256) for c in range(0, 256, 5)]
    want = {}
    for k in keys:
        tree.insert(k, 1)
        for d in range(len(k) // 4 + 1):
            want[k[:4 * d]] = want.get(k[:4 * d], 0) + 1
    assert sorted(tree.totals(4)) == sorted((len(k) // 4, n) for k, n in want.items())
    assert tree.n_keys == len(set(keys))


@pytest.mark.parametrize("fan", [1, 4, 5, 16, 17, 48, 49, 256])
def test_node_layouts_grow_with_children(fan):
    tree = radix_tree.RadixTree(lambda a, b: a + b)
    order = random.Random(fan).sample(range(256), fan)
    for b in order + order:
        tree.insert(bytes([b, 7]), 1)
    kind = type(tree.root.kids).__name__, getattr(tree.root.kids, "room", 0)
    assert kind == (("_Sorted", 4) if fan <= 4 else ("_Sorted", 16) if fan <= 16 else ("_Indexed", 0) if fan <= 48 else ("_Direct", 0))
    assert [b for b, _ in tree.root.kids.items()] == sorted(order)
    assert sorted(tree.totals(2)) == [(0, 2 * fan)] + [(1, 2)] * fan
