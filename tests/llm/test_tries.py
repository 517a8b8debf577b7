"""Prefix trie, exact dedup and token alignment against SQL or brute force, with odd rows."""

import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pacegrid.llm import alignment, cuckoo_dedup, prefix_trie, queries, token_ids
from tests.oracle import connect, differences

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


def duck_with(**frames):
    duck = duckdb.connect()
    for name, frame in frames.items():
        table = frame.toPandas()
        for column, kind in frame.dtypes:
            if kind == "bigint":
                table[column] = pd.array(table[column], "Int64")
        duck.register(name, table)
    return duck


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_cuckoo_dedup"])
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


@pytest.fixture(scope="module")
def odd_turns(spark):
    """Absent bases, negative ids, ties, repeated rows, nulls in every column, long conversations."""
    draw, rows = random.Random(5), []
    for conv in [*range(-130, -95), *range(-5, 9), *range(100, 120), 205, 206, -(2**62)]:
        for turn in range(draw.choice([1, 2, 3, 7, 9])):
            rows.append((conv, draw.choice([None, turn, turn, turn]), draw.choice(["u", "a", None]), draw.choice(["x", "", None, "z" * 5_000]), b"k"))
    rows += [(110, 5, "u", "x", None)] * 7 + [(None, 1, "u", "q", None)]
    rows += [(conv, i, "u", "x", None) for conv in (101, 107) for i in range(150)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key binary").repartition(5).cache()


def test_trie_of_odd_turns(spark, odd_turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    duck = duck_with(conversations=odd_turns.drop("key"))
    assert differences(prefix_trie.trie(odd_turns).drop("last_ref"), duck, queries.ORACLES["op11_prefix_trie"]) == ""
    # References of one byte and a small modulus conflict, and are made longer.
    assert differences(prefix_trie.trie(odd_turns, 1, 101).drop("last_ref"), duck, queries.ORACLES["op11_prefix_trie"]) == ""
    assert prefix_trie.trie(odd_turns.limit(0)).isEmpty()
    nodes = prefix_trie.trie(odd_turns).where("depth > 0")
    assert nodes.join(prefix_trie.turn_store(odd_turns).withColumnRenamed("ref", "last_ref"), "last_ref", "left_anti").isEmpty()


def test_products_compose():
    monoid, draw = prefix_trie.Monoid(), random.Random(1)
    turns = [monoid.turn(draw.randbytes(32)) for _ in range(9)]

    def product(maps):
        whole = prefix_trie.ONE
        for one in maps:
            whole = monoid.times(whole, one)
        return whole

    for cut in range(10):
        head, whole = product(turns[:cut]), product(turns)
        assert monoid.times(head, product(turns[cut:])) == whole
        assert monoid.times(monoid.inverse(head), whole) == product(turns[cut:])


def test_dedup_of_odd_rows(spark, odd_docs, no_docs):
    spaced = spark.createDataFrame([(i, " " * (i % 3) + f"t{i % 5}\n\t\x0b\x0c\r") for i in range(40)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(spaced)
    assert differences(cuckoo_dedup.dedup(docs), duck_with(documents=docs), queries.ORACLES["op12_cuckoo_dedup"]) == ""
    assert cuckoo_dedup.dedup(odd_docs).count() == odd_docs.count() and cuckoo_dedup.dedup(no_docs).isEmpty()


def test_index_takes_in_and_gives_back(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(cuckoo_dedup, "BUCKET_KEYS", 20)

    def told(frame):
        return sorted(map(tuple, frame.collect()))

    whole = told(cuckoo_dedup.dedup(docs))
    assert told(cuckoo_dedup.dedup(docs, key_bytes=1)) == whole  # conflicting keys grow
    few, rest = docs.where("doc_id % 9 = 0"), docs.where("doc_id % 9 <> 0")
    first = cuckoo_dedup.build(few)
    both = first.insert(rest)
    assert both.buckets > first.buckets and told(cuckoo_dedup.groups(both)) == whole
    less = both.delete(rest).delete(rest)  # what isn't in the index any more is ignored
    assert told(cuckoo_dedup.groups(less)) == told(cuckoo_dedup.groups(first)) == told(cuckoo_dedup.dedup(few))
    filters = {r.bucket: cuckoo_dedup.CuckooFilter(cells=r.blob) for r in less.filters().collect()}
    live = less.keys().collect()
    assert all(filters[r.bucket].holds(r.key) for r in live)
    assert sum(1 for f in filters.values() for cell in f.cells if cell) == len(live)
    assert less.delete(few).keys().isEmpty()


def test_copies_in_very_many_tasks(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat(' ', cast(id % 7 AS int)) || 'same', 't' || id) AS text")
    out = cuckoo_dedup.dedup(docs.repartition(80)).toPandas()
    hot = out[out.group_size > 1]
    assert len(out) == 900 and set(hot.group_size) == {300} and set(hot.keep_id) == {6} and hot.kept.sum() == 1


def test_filter_without_room_is_made_anew():
    small, keys = cuckoo_dedup.CuckooFilter(4), [str(i).encode() for i in range(60)]
    held = [k for k in keys if small.insert(k)]
    assert 8 <= len(held) < 60 and all(small.holds(k) for k in held)
    larger = small.resized(keys)
    assert all(larger.holds(k) for k in keys) and all(larger.delete(k) for k in keys) and not any(larger.cells)


TEXTS = [None, "", "a", "▁a b", "a ▁ b c", "\0 a", "a  b \n c\t d   ", " lead", "x\x1cy z", "😀 é ß ΣΑΣ", "<|endoftext|> x <s> <0x41> a"]
TEXTS += ["a　b c", "a  b", "\n\n a", "'s it's  's", "a" * 300 + " b", "x" * 20_000, " " * 120_000 + "q", "日本語テキスト" * 900]


def alone(pair, text):
    """Groups and links of one text from both end arrays, without skipping."""
    ids = pair.whole(text) if text else None
    if ids is None:
        return (0, 0, 0, 0, ""), []
    a, b = ids
    ends_a, ends_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    common, groups = sorted(set(ends_a.tolist()) & set(ends_b.tolist())), []
    cuts_a, cuts_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
    for i, i2, j, j2 in zip([0, *cuts_a], cuts_a, [0, *cuts_b], cuts_b):
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
    ends = np.union1d(ends_a, ends_b)
    links = list(zip(a[np.searchsorted(ends_a, ends)].tolist(), b[np.searchsorted(ends_b, ends)].tolist()))
    return (len(a), len(b), len(common), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def aligned_alone(texts):
    pair = alignment.Pair(BYTES, PIECES)
    told = [alone(pair, text) for text in texts]
    counts, best = {}, {}
    for _, links in told:
        for link in links:
            counts[link] = counts.get(link, 0) + 1
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(*head[:4], sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), head[4]) for head, links in told]


@pytest.mark.parametrize("common", [1_000_000, 40, 0])
def test_alignment_equals_brute_force(spark, odd_docs, no_docs, common):
    draw = random.Random(3)
    texts = [*TEXTS, *("".join(draw.choice("ab'st. \n\té9-▁ ") for _ in range(draw.randint(0, 14))) for _ in range(300))]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, pairs string").repartition(3)
    out = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, BYTES, PIECES, common=common).collect()}
    assert [out[i] for i in range(len(texts))] == aligned_alone(texts)
    assert alignment.align(odd_docs, BYTES, PIECES, common=common).count() == odd_docs.count()
    assert alignment.align(no_docs, BYTES, PIECES, common=common).isEmpty()


def test_many_starts_give_the_groups_of_one():
    draw = np.random.default_rng(4)
    for _ in range(60):
        ends = np.arange(1, 4_001)
        a, b = (np.union1d(ends[draw.random(4_000) < share], [4_000]) for share in draw.choice([0.2, 0.6, 0.95], 2))
        common = np.intersect1d(a, b)[:-1]
        some = common[:: draw.integers(1, 40)]
        starts = [np.concatenate(([0], np.searchsorted(side, some) + 1)) for side in (a, b)]
        groups, link_a, link_b = alignment.irregular_from(a, b, *starts)
        one, left, right = alignment.irregular_groups(a.tolist(), b.tolist())
        assert sorted(map(tuple, groups.tolist())) == one and sorted(zip(link_a.tolist(), link_b.tolist())) == list(zip(left, right))


@pytest.mark.parametrize("run", [" ", "\n", "　", " \n\t"])
def test_long_white_space_is_encoded_as_by_the_library(run):
    library, known = Tokenizer.from_file(BYTES), token_ids.encoding(BYTES)
    for text in (run * 130_000, "a" + run * 130_000 + "b c", run * 110_000 + "<|endoftext|>" + run * 120_000 + ".\n"):
        assert token_ids.encoded(text, known).tolist() == library.encode(text, add_special_tokens=False).ids
    blanks = "x" + " " * 5_000_000 + "y"
    assert len(token_ids.encoded(blanks, known)) == 5_000_001


def test_files_of_another_kind_are_refused(tmp_path):
    with pytest.raises(ValueError):
        token_ids.encoding(public_tokenizers.path("word_bpe_49k.json"))
