import struct
import zlib
from glob import glob

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrass.llm import tokens as K
from tallgrass.llm.queries import tokenizer_file
from tallgrass.llm.shingles import utf8
from tallgrass.plans.durable import scratch

ODD = ["", "a", "a  b", "a\n\n\nb c", "a \n b", "x\xa0 y ", " lead", "trail ", "tail\n", "it's, don't... 'tis\n(ok) <|endoftext|>", "a\0b c", "　q r",
       "1,000 a1b2 c3.", "é, ñandú! ÇA??\n\tb", "%%% &&& ***", "a b\n\nc", "“q” — x’s é's a's b'", "\x85", "日本語 テキスト。 مرحبا 12３ ½ ²"]


def direct(text):
    tokenizer = Tokenizer.from_file(tokenizer_file())
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(prose):
    encode = K.Encoder(tokenizer_file(), 2)
    texts = [*ODD, *(prose(k, 300).replace(" re", ".\nre").replace("sa ", "sa, ") for k in range(5))]
    for some in (texts, texts[::-1], [""], []):
        ids, counts = encode(*utf8(pa.array(some, pa.string()))) if some else (np.zeros(0), [])
        at = 0
        for text, n in zip(some, counts):
            assert ids[at : at + n].tolist() == [*direct(text), 2], text
            at += n
        assert at == len(ids)


def test_a_full_memory_changes_no_ids(monkeypatch, prose):
    monkeypatch.setattr(K, "REMEMBERED", 40)
    encode = K.Encoder(tokenizer_file(), 2)
    for k in range(6):
        assert encode(*utf8(pa.array([prose(k % 4, 60)])))[0].tolist() == [*direct(prose(k % 4, 60)), 2]


def test_parts_of_a_long_text():
    text = ("ab cd, " * 5000 + "  \n ") * 4
    data = np.frombuffer(text.encode(), np.uint8)
    cuts = K._parts(data, 1 << 12)
    encode = K.Encoder(tokenizer_file(), 2)
    got = np.concatenate([encode(data[a:b], np.array([0, b - a]))[0][:-1] for a, b in zip(cuts[:-1], cuts[1:])])
    assert len(cuts) > 10 and got.tolist() == direct(text)


def test_files(spark, make_docs, prose):
    long = "wort " * 1_000_000
    rows = [(k * 7 % 50, prose(k, 30)) for k in range(50)] + [(3, None), (3, "a"), (None, "b"), (99, long), (100, "z")]
    path = scratch(spark, "tokens-test")
    K.write_tokens(make_docs(rows).repartition(3), path, tokenizer_file())
    found = K.with_crc(K.read_tokens(spark, path)).orderBy("start").collect()
    at = 0
    for r, (doc_id, text) in zip(found, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), strict=True):
        ids = [*direct(text or ""), 2]
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    files = sorted(glob(path.removeprefix("file://") + "/*.parquet"))
    firsts = [pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    flat = [x for own in firsts for x in own]
    assert flat == sorted(flat, key=lambda x: (x is not None, x or 0))
    group = pq.ParquetFile(files[-1]).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_offset_index
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY"} & set(ids.encodings) and ids.has_offset_index
    plan = K.read_tokens(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "ids" not in plan.partition("== Physical Plan ==")[2]


def test_empty_table(spark, make_docs):
    path = scratch(spark, "tokens-none")
    K.write_tokens(make_docs([]), path, tokenizer_file())
    assert K.with_crc(K.read_tokens(spark, path)).collect() == []


def test_special_tokens_as_the_library_has_them(spark, make_docs, prose):
    """Written files have the ids of the library's own defaults, whatever is in a text, of one part or of many."""
    tokenizer = Tokenizer.from_file(tokenizer_file())
    mark = "<|endoftext|>"
    texts = [f"hello {mark} world", f"a{mark}b", mark, f"{mark} {mark}\n{mark}", "<|endoftext |> <|endoftext", f"é{mark}é", prose(1, 30), f"a  b{mark}  c", "wort " * 500_000 + mark + " wort" * 1_000_000]
    path = scratch(spark, "tokens-special")
    K.write_tokens(make_docs(list(enumerate(texts))).repartition(2), path, tokenizer_file())
    found = K.read_tokens(spark, path).orderBy("doc_id").collect()
    assert found[0].ids == [31373, 220, 50256, 995, 2]
    for r, text in zip(found, texts, strict=True):
        assert r.ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text[:60]


def test_pieces_with_equal_hashes():
    """Thue-Morse words of 2,048 letters have one polynomial hash modulo 2**64; 1,024 letters too, for this base."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        encode = K.Encoder(tokenizer_file(), 2)
        texts = [f"x {word} y {other} {word}", f"z {other} {other} y"]
        ids, counts = encode(*utf8(pa.array(texts)))
        assert ids.tolist() == [*direct(texts[0]), 2, *direct(texts[1]), 2], len(word)
    data = np.frombuffer(f"{word}{other}".encode(), np.uint8)
    hashes = K._piece_hashes(data, np.array([0, len(word)]))
    assert hashes[0] == hashes[1]


def test_rows_without_an_id_are_dealt_out(spark, make_docs, prose):
    rows = [(None, prose(k, 20)) for k in range(400)] + [(1, "a")]
    ordered = K._in_ranges(make_docs(rows))
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 401 and max(sizes) < 250
