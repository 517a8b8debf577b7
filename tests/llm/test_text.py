"""Text operators against brute force: patterns, the tokenizers library, exact round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pacegrid.llm import bfd_packing, concat_cut, lexicon_bpe, pii
from tests.llm.conftest import ODD

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def base_spans(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [("ip", m.start(), m.end())] * all(int(p) <= 255 for p in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        found += [("card", m.start(), m.end())] * (13 <= len(digits) <= 19 and pii.luhn(digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [("phone", m.start(), m.end())] * (9 <= sum(c.isdigit() for c in m[0]) <= 15)
    return found


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(1)
    for _ in range(5_000):
        text = "".join(draw.choice("0012345@@..+- ()aZ-_\né") for _ in range(draw.randint(0, 60)))
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_cues_and_redaction():
    text = "see http://a.example/x. account 1234 5678 9012, 12 Long Elm street, mail a.b@c.de now"
    kinds = [k for k, _, _ in pii.find_spans(text)]
    assert kinds == ["email", "url", "account", "address"]
    assert pii.redacted(text, pii.find_spans(text)) == "see [URL]. [ACCOUNT]".replace("[ACCOUNT]", "account [ACCOUNT]") + ", [ADDRESS], mail [EMAIL] now"


def test_accounts_and_addresses_of_four_languages():
    def told(text):
        return [(kind, text[a:b]) for kind, a, b in pii.find_spans(text)]

    assert told("iban DE89 3704 0044 0532 0130 00 ok") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert told("IBAN: GB29NWBK60161331926819, x") == [("account", "GB29NWBK60161331926819")]
    assert told("iban DE89 3704 0044 0532 0130 01") == []
    assert told("mot de passe: abc12345678") == [("account", "abc12345678")]
    assert told("account number 12345678 and") == [("account", "12345678")]
    addresses = ["12 Long Elm street", "12, rue de la Paix", "calle Mayor 12", "Hauptstraße 12"]
    assert [told(f"in {a}.") for a in addresses] == [[("address", a)] for a in addresses]
    for text in ("see road 12", "strasse 5", "la rue", "calle", "street", "calle Mayor", "rue 5", "12 rue"):
        assert told(text) == []
    assert pii.find_spans("straße" * 200_000) == [] and pii.find_spans("calle " * 200_000) == []


def test_base_digests_of_the_table_are_those_of_the_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r for r in pii.span_digests(docs).collect()}
    for row in docs.collect():
        spans = base_spans(row.text or "")
        told = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        assert found[row.doc_id].base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert found[row.doc_id].n_email == sum(kind == "email" for kind, _, _ in spans)


def test_encoded_and_decoded(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text")
    library = Tokenizer.from_file(WORDS)
    name = lexicon_bpe.publish_lexicon(docs, WORDS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in lexicon_bpe.encoded(docs, WORDS, name).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False) == lexicon_bpe.decode(ids, WORDS)


def test_words_of_steady_texts_are_those_of_the_property_pattern():
    import regex

    by_property, draw = regex.compile(lexicon_bpe.WORDS), random.Random(6)
    _, spelled = lexicon_bpe.steady_words()
    spans = [lexicon_bpe.STEADY[i : i + 3] for i in range(0, len(lexicon_bpe.STEADY), 3)]
    steady = [chr(c) for a, _, b in spans for c in range(ord(a), ord(b) + 1)]
    for _ in range(3_000):
        text = "".join(draw.choice(steady[:1328] if draw.random() < 0.8 else steady) for _ in range(30))
        assert spelled.findall(text) == by_property.findall(text)


def test_written_matrices_hold_the_packed_ids(spark, odd_docs, tmp_path):
    rows = bfd_packing.pack(odd_docs, BYTES, width=128)
    bfd_packing.write_matrices(rows, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    columns = ["sequence_id", "input_ids", "cu_seqlens", "position_resets"]
    assert sorted(written.select(columns).collect()) == sorted(rows.select(columns).collect())


def test_long_white_space_goes_through_both_packings(spark):
    texts = [" " * 1_200_000, "a" + "\n" * 1_100_000 + "b", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = {i: len(ids) for i, ids in enumerate(expected_ids(texts))}
    pieces = concat_cut.pack_pieces(docs, BYTES).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id: r[1] for r in pieces} == sizes
    found = dict.fromkeys(sizes, 0)
    for row in bfd_packing.pack(docs, BYTES).select("doc_ids", "cu_seqlens").collect():
        for doc, a, b in zip(row.doc_ids, row.cu_seqlens, row.cu_seqlens[1:]):
            found[doc] += b - a
    assert found == sizes


def test_span_digests_of_odd_rows(odd_docs, no_docs):
    out = pii.span_digests(odd_docs).collect()
    assert len(out) == odd_docs.count() and pii.span_digests(no_docs).isEmpty()
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in out)
    again = pii.redact(odd_docs)
    assert again.columns == odd_docs.columns and again.exceptAll(odd_docs).isEmpty()


def expected_ids(texts):
    library = Tokenizer.from_file(BYTES)
    return [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_windows_hold_every_id_once(odd_docs, no_docs):
    rows = odd_docs.collect()
    pieces = [r.asDict() for r in concat_cut.pack_pieces(odd_docs, BYTES, window=64, with_ids=True).collect()]
    by_sequence = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    place = 0
    for p in by_sequence:
        assert (p["sequence_id"], p["offset"]) == divmod(place, 64)
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"]
        place += p["length"]
    rebuilt = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        rebuilt.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], "<u4").tolist())
    expected = {}
    for row, ids in zip(rows, expected_ids([r.text for r in rows])):
        expected.setdefault(row.doc_id, []).extend(ids)
    assert rebuilt == expected
    assert concat_cut.pack_pieces(no_docs, BYTES).isEmpty()


def test_sequences_are_padded_lines(odd_docs):
    pieces = concat_cut.pack_pieces(odd_docs, BYTES, window=64, with_ids=True)
    lines = concat_cut.sequences(pieces, 64).collect()
    assert {len(r.input_ids) for r in lines} <= {64, 32, 16, 8, 4, 2, 1} and all(r.segment_starts[0] == 0 for r in lines)


def test_best_fit_takes_the_tightest_bin():
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 65, 400)
    bins = bfd_packing.best_fit_decreasing(lengths, 64)
    rooms, expected = [], []
    for piece in np.argsort(-lengths, kind="stable"):
        fits = [r for r in rooms if r >= lengths[piece]]
        if fits:
            rooms[rooms.index(min(fits))] -= lengths[piece]
        else:
            rooms.append(64 - lengths[piece])
    expected = sorted(rooms)
    assert sorted(64 - sum(lengths[b]) for b in bins) == expected
    assert sorted(p for b in bins for p in b) == list(range(400))


def test_packed_matrices_lose_nothing(odd_docs, no_docs):
    found = {}
    for row in bfd_packing.pack(odd_docs, BYTES, width=128).collect():
        line = np.frombuffer(row.input_ids, "<u4")
        assert len(line) == 128 and row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens
        assert row.position_resets == (row.cu_seqlens if row.n_tokens < 128 else row.cu_seqlens[:-1])
        for doc, start, a, b in zip(row.doc_ids, row.starts, row.cu_seqlens, row.cu_seqlens[1:]):
            found.setdefault(doc, []).append((start, tuple(line[a:b].tolist())))
    rows = odd_docs.collect()
    expected = {}
    for row, ids in zip(rows, expected_ids([r.text for r in rows])):
        expected.setdefault(row.doc_id, []).extend((s, tuple(ids[s : s + 128])) for s in range(0, len(ids), 128))
    assert {d: sorted(p) for d, p in found.items()} == {d: sorted(p) for d, p in expected.items()}
    assert bfd_packing.pack(no_docs, BYTES).isEmpty()


def test_positions_begin_again(odd_docs):
    rows = bfd_packing.pack(odd_docs.limit(4), BYTES, width=16)
    for row in rows.join(bfd_packing.positions(rows, 16), "sequence_id").collect():
        assert [i for i, p in enumerate(row.position_ids) if p == 0] == row.position_resets


def test_ids_and_texts_are_the_library_s(spark, odd_docs, no_docs):
    library = Tokenizer.from_file(WORDS)
    texts = [*(t or "" for t in ODD), "it's we'LL 12½ __x__", "a\x1cb \x85 c\u3000d", "therefore" * 9, "null id"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for words in (0, 5):  # everything merged; a small transducer
        out = lexicon_bpe.digests(docs, WORDS, lexicon_bpe.publish_lexicon(docs, WORDS, words)).collect()
        for row in out:
            ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
            assert row.n_tokens == len(ids)
            assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            decoded = library.decode(ids, skip_special_tokens=False)
            assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    name = lexicon_bpe.publish_lexicon(odd_docs, WORDS)
    assert lexicon_bpe.digests(odd_docs, WORDS, name).count() == odd_docs.count()
    assert lexicon_bpe.digests(no_docs, WORDS, lexicon_bpe.publish_lexicon(no_docs, WORDS)).isEmpty()


def test_transducer_is_minimal_and_exact(tmp_path):
    words = sorted({"".join(random.Random(i).choices("abc", k=i % 7 + 1)) for i in range(300)})
    (tmp_path / "lexicon").write_bytes(lexicon_bpe.lexicon_bytes(words, WORDS))
    lexicon = lexicon_bpe.Lexicon(str(tmp_path / "lexicon"))
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    others = [w + "d" for w in words] + [w + "a" * 9 for w in words]
    assert set(lexicon.numbers(others).tolist()) == {-1}
    known = lexicon_bpe.merges(WORDS)
    assert all(lexicon.ids_of(i) == known.merge(w) for i, w in enumerate(words))
    suffixes = {frozenset(w[i:] for w in words if w[:i] == p) for p in {w[:i] for w in words for i in range(len(w) + 1)} for i in [len(p)]}
    assert len(np.unique(lexicon.keys >> 8)) == len(suffixes)


def test_both_ways_of_merging_agree():
    known, draw = lexicon_bpe.merges(WORDS), random.Random(4)
    for _ in range(500):
        parts = [known.inner[draw.choice(b"etaoinsrhld")] for _ in range(draw.randint(1, 40))]
        assert known.merge_short(list(parts)) == known.merge_long(list(parts))
