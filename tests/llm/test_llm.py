"""Every operator against a plain version, a round trip or held-out labels, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from podwatch.llm import chat, memory, near_dedup, perfect_hash, quality, warc
from podwatch.llm import line_dedup as line_dedup_module
from podwatch.llm.components import connected_components
from podwatch.llm.decontaminate import contaminated
from podwatch.llm.fingerprints import fingerprints, likeness
from podwatch.llm.line_dedup import line_dedup
from podwatch.llm.minhash import mixed, one_permutation
from podwatch.llm.near_dedup import near_duplicates
from podwatch.llm.oracles import ORACLES
from podwatch.llm.packing import packed
from podwatch.llm.quality import isotonic, quality_scores
from podwatch.llm.queries import QUERIES, tokenizer_path
from podwatch.llm.scratch import Scratch
from podwatch.llm.token_counts import token_counts
from podwatch.llm.tokens import Pieces, added_tokens, byte_level_pieces, id_pieces, word_pieces
from podwatch.llm.url_filters import intervals, url_patterns, url_verdicts

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(spark, *texts):
    return spark.createDataFrame([(k, t, "en", "s", None) for k, t in enumerate(texts)], DOCS)


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_components(texts):
    sets = {k: plain_set(t) for k, t in texts.items()}
    of = {k: k for k in sets}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}, sets


AWKWARD = [None, "", " \t\n", "one", "One", "a b c d e f", "a b c d e f", "é É ö", "x " * 30_000, "line\n" * 50]


# WARC


def test_warc_round_trip(spark):
    schema = "page_id long, url string, html string, n int"
    same = [(k, f"http://a/{k}", "<p>same</p>", 1) for k in range(40)]
    pages = [*same, (100, None, None, 1), (101, "http://b/%0A\n", "", 1), (102, "u", "é\r\n\r\nWARC/1.1\r\n" * 9, 1), (103, "u", "x" * 300_000, 1), (None, "v", "alone", 1)]
    got = {(r.page_id, r.url): r for r in warc.round_trip(spark.createDataFrame(pages, schema).repartition(3)).collect()}
    assert len(got) == len(pages)
    for page_id, url, html, _ in pages:
        r, payload = got[page_id, url], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), warc.digest_of(payload))
        last = {"<p>same</p>": 39, None: 101, "": 101}.get(html, page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if last == page_id else ("revisit", last))
        assert r.payload == (payload if last == page_id else None)


def test_warc_small_payloads_are_responses_and_selection_reads_only_what_is_named(spark):
    pages = spark.createDataFrame([(k, "u", "ab") for k in range(5)] + [(9, "u", "abcdef"), (8, "u", "abcdef")], "page_id long, url string, html string")
    folder = Scratch(spark, "warc-test").folder
    index = warc.write_archives(pages, folder, least_bytes=3)
    assert {r.page_id: r.record_type for r in index.collect()} == {**dict.fromkeys(range(5), "response"), 9: "response", 8: "revisit"}
    found = warc.read_records(index.where("page_id in (8, 3)"), folder).collect()
    assert sorted((r.page_id, r.refers_to) for r in found) == [(3, None), (8, 9)]
    empty = Scratch(spark, "warc-test").folder
    assert warc.read_records(warc.write_archives(pages.limit(0), empty), empty).count() == 0


# Near-duplicates


def test_signature_borrows_for_empty_bins():
    few = np.unique(mixed(np.array([5, 6, 7], dtype=np.uint64)))
    assert set(one_permutation(few, 64).tolist()) == set(few.tolist())
    big = np.unique(np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64))
    part = big[np.random.default_rng(1).random(len(big)) < 0.8]
    alike = np.mean(one_permutation(big, 384) == one_permutation(part, 384))
    assert abs(alike - len(part) / len(big)) < 0.08


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choices(vocabulary, k=rng.choice([3, 6, 12, 60, 150])) for _ in range(25)]
    hub = rng.choices(vocabulary, k=80)
    texts = []
    for words in [*base, *[hub] * 30]:
        for _ in range(3):
            changed = list(words)
            for _ in range(rng.randrange(0, 4)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            texts.append(" ".join(changed))
    texts += AWKWARD
    expected, sets = plain_components(dict(enumerate(texts)))
    got = near_duplicates(rows(spark, *texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert {r.doc_id: r.n_shingles for r in got} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_short_texts_are_linked_whatever_their_sketches(spark):
    texts = {}
    for k in range(150):
        for n, end in ((8, 1), (9, 1), (10, 1), (12, 1), (20, 2), (40, 5)):  # J = (n - 4 - end) / (n - 4): 0.75 to 0.88
            words = [f"w{k}x{n}x{i}" for i in range(n)]
            texts |= {len(texts): " ".join(words), len(texts) + 1: " ".join(words[:-end])}
    expected, _ = plain_components(dict(list(texts.items())[:120]))
    assert all(expected[k] == k - k % 2 for k in range(120))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {k: k - k % 2 for k in texts}


def test_sketches_refuse_no_link_and_most_others(spark):
    rng = np.random.default_rng(5)
    rows_of = {}
    for n in (4, 8, 100, 500, 1000, 1022, 1400, 5000):  # shingles of the smaller set
        for part in (0.75, 0.5):
            for k in range(40):
                both = np.unique(mixed(rng.integers(0, 2**63, n, dtype=np.uint64)))
                more = np.unique(mixed(rng.integers(0, 2**63, int(n / part) - n, dtype=np.uint64)))
                rows_of[n, part, k] = (both, np.unique(np.concatenate([both, more])))
    data = []
    for (n, part, k), sets in rows_of.items():
        data.append((n, part, k, *(v for s in sets for v in (len(s), *map(int, near_dedup.sketch(s))))))
    names = [f"{x}{c}" for x in "xy" for c in ("n", *near_dedup.SKETCH)]
    frame = spark.createDataFrame(data, ", ".join(["n long", "part double", "k long", *(f"{c} long" for c in names)]))
    assert frame.where("part = 0.75").where(~near_dedup._alike("x", "y")).count() == 0
    # A pair of equal size at 0.5 is refused by its sketch alone.
    for n in (100, 500, 1000, 5000):
        a, b = (np.unique(np.concatenate([rows_of[n, 0.5, 0][0], mixed(rng.integers(0, 2**63, n // 2, dtype=np.uint64))])) for _ in "ab")
        one = spark.createDataFrame([(len(a), *map(int, near_dedup.sketch(a)), len(b), *map(int, near_dedup.sketch(b)))], ", ".join(f"{c} long" for c in names))
        assert one.where(near_dedup._alike("x", "y")).count() == 0


def test_near_duplicates_of_the_test_documents(spark, documents):
    expected, _ = plain_components({r.doc_id: r.text for r in documents.collect()})
    assert {r.doc_id: r.component_id for r in near_duplicates(documents).collect()} == expected


def test_near_duplicates_without_ids_repeated_ids_and_no_rows(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (2, text), (3, None)], "doc_id long, text string").withColumn("component", F.lit("x"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (3, 3, True)], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    def text(name, changed=0):
        return " ".join([f"{name}{k}" for k in range(40 - changed)] + [f"{name}other{k}" for k in range(changed)])

    found = [
        (1, text("a")), (2, text("a")), (2, text("b")), (3, text("b", 1)),  # one text is a copy, the other near another document
        (12, text("c")), (11, text("d")), (12, text("d")), (13, text("c")), (14, text("c", 1)),  # one stands for copies
        (21, text("e")), (21, text("e", 1)), (21, text("e", 2)), (22, text("f")), (22, text("e", 3)), (23, text("f", 1)), (24, text("g")), (24, text("g")),
    ]
    docs = spark.createDataFrame([*found, (None, text("a")), (None, text("b"))], "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    of = {1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11, 14: 11, 21: 21, 22: 21, 23: 21, 24: 24}
    assert got == Counter([*((k, of[k], k == of[k]) for k, _ in found), (None, None, True), (None, None, True)])


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(1000, k) for k in range(900, 960)] + [(5000, 5001), (7, 7)]
    scratch = Scratch(spark, "components-test")
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), scratch, "t").collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys([1000, *range(900, 960)], 900), 5000: 5000, 5001: 5000}


# Lines


def plain_lines(texts):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    where = defaultdict(set)
    for k, t in texts.items():
        for line in (t or "").split("\n"):
            where[key(line)].add(k)
    gone = {x: max(ids) for x, ids in where.items() if len(x) >= 40 and len(ids) >= 5}
    out = {}
    for k, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), k) == k]
        out[k] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_lines_match_brute_force(spark):
    rng = random.Random(3)
    common = [f"{'é' * k} this line number {k} is said by many documents" for k in range(30)] + ["x" * 39, "y" * 40, "É" * 39, "Z" * 41]
    texts = ["\n".join(rng.choice([c, f"  {c.upper()}\t", c, "short", f"only here {rng.random()} and nowhere else at all"]) for c in rng.choices(common, k=12)) for _ in range(80)]
    texts += AWKWARD
    expected = plain_lines(dict(enumerate(texts)))
    docs = rows(spark, *texts).withColumn("kept_text", F.lit(1))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup(docs).collect()}
    assert got == expected
    assert sum(n for _, n, _ in got.values()) > 50


def test_lines_without_ids_repeated_ids_and_no_rows(spark):
    line = "a line that is long enough to be looked at by the operator"
    docs = spark.createDataFrame([(k, line) for k in (1, 2, 3, 4, 9, 9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_dropped) for r in line_dedup(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 1), (9, 0), (9, 0), (None, 0)], key=str)
    assert line_dedup(docs.limit(0)).count() == 0


def test_lines_count_documents_not_rows(spark):
    line = "a line that is long enough to be looked at by the operator"
    docs = spark.createDataFrame([(k, f"{line}\nown {k}") for k in (1, 1, 1, 1, 2)] + [(k, f"{line} too") for k in (3, 3, 4, 5, 6, 7, 7)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_dropped) for r in line_dedup(docs).collect())
    assert got == [(1, 0)] * 4 + [(2, 0)] + [(3, 1)] * 2 + [(4, 1), (5, 1), (6, 1), (7, 0), (7, 0)]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 20_000, dtype=np.uint64))
    sizes, bits, index = perfect_hash.build(keys)
    assert sorted(index.tolist()) == list(range(len(keys)))
    assert (perfect_hash.lookup(keys, sizes, bits) == index).all()
    assert len(bits) < len(keys)


# Fingerprints


def plain_phrases(text):
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


def test_fingerprints_follow_the_next_document(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    texts |= {1000 + k: t for k, t in enumerate(AWKWARD)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(got) == sorted(texts)
    errors = []
    for doc, following in zip(order, order[1:] + order[:1], strict=True):
        text, after = texts[doc] or "", texts[following] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        back = [np.frombuffer(bytes.fromhex(x), dtype=np.uint8) for x in (r.fingerprint, r.edited_fingerprint, got[following].fingerprint)]
        assert r.near_edited == pytest.approx(likeness(back[0], back[1])) and r.near_next == pytest.approx(likeness(back[0], back[2]))
        assert (text == edited) <= (r.fingerprint == r.edited_fingerprint)
        if len(text) > 200:
            a, b = plain_phrases(text), plain_phrases(edited)
            errors.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07
    assert np.mean([r.near_edited for r in got.values() if r.n_chars > 200]) > 0.2 + np.mean([r.near_next for r in got.values() if r.n_chars > 200])


def test_fingerprints_of_few_and_odd_rows(spark):
    kinds = "doc_id long, text string"
    assert fingerprints(spark.createDataFrame([], kinds)).count() == 0
    one = fingerprints(spark.createDataFrame([(3, "abcabc")], kinds)).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcaab").hexdigest()
    odd = fingerprints(spark.createDataFrame([(None, "n"), (2, "bbb"), (2, "aaa"), (1, None)], kinds)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in odd) == [("1", 0), ("2", 3), ("2", 3), ("None", 1)]


# Quality


def test_isotonic_pools_what_falls():
    assert isotonic(np.array([1.0, 1, 2]), np.array([1.0, 0, 2])).tolist() == [0.5, 0.5, 1.0]


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_scores(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where("held_out")
    good = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("predicted")))).first()
    assert good[0] > 0.97 and good[1] > 0.99
    assert got.where("score < 0 or score > 1").count() == 0


def test_quality_ignores_labels_of_held_out_rows_and_other_columns(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in quality_scores(documents, labels).collect()}
    again = {r.doc_id: r.score for r in quality_scores(documents.withColumn("score", F.lit("x")).withColumn("lang", F.lit(None)), turned).collect()}
    assert first.keys() == again.keys() and all(abs(first[k] - again[k]) < 1e-6 for k in first)


def test_quality_without_labels_and_of_awkward_texts(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_scores(rows(spark, *AWKWARD).union(rows(spark, "x").withColumn("doc_id", F.lit(None).cast("long"))), none).collect()
    assert [r.score for r in got] == [1.0] * (len(AWKWARD) + 1) and sum(r.held_out for r in got if r.doc_id is None) == 1
    one_class = spark.createDataFrame([(k, 1) for k in range(10)] + [(3, None)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in quality_scores(rows(spark, *AWKWARD), one_class).collect())
    assert quality_scores(rows(spark), none).count() == 0


# Tokens


ODD = [
    "a  b\n\nc \n d e  f\x1cg\x85h　 i", "don't I'LL we've 'S", "<|endoftext|>x<|startoftext|> y <|endoftext|>", "  lead", "trail  ", "\t\t\n", "日本語 です  テスト",
    "é ́x", "ΑΣ ΣΑΣ İ ǅ", "x" * 5000, "3,141.59 km — “quoted” … 🤦🏼‍♂️ ok", "\x00\x01 a\x00b", "a ​ b", "\r\n a\r\n\r\nb",
]


def library_ids(name, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def random_texts(n=300):
    rng = random.Random(11)
    parts = [*"abc XYZ012.,!'", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", " ", "é", "ß", "'s", "'ll", "<|endoftext|>", "<|", "日", "́", "🤦"]
    return ["".join(rng.choices(parts, k=rng.randrange(0, 40))) for _ in range(n)]


def all_pieces(text, added=None):
    return [" " + p if isinstance(p, str) else p.decode() for part in byte_level_pieces(text, added) for p in part]


def test_pieces_give_the_librarys_ids():
    from tokenizers import Tokenizer

    texts = ODD + random_texts()
    for name, cut in (("byte_bpe_50k.json", all_pieces), ("word_bpe_49k.json", word_pieces)):
        tokenizer = Tokenizer.from_file(tokenizer_path(name))
        for text, ids in zip(texts, library_ids(name, texts), strict=True):
            pieces = [p.decode() if isinstance(p, bytes) else p for p in cut(text)]
            assert [i for p in pieces for i in tokenizer.encode(p, add_special_tokens=False).ids] == ids, repr(text)


def test_white_space_before_special_strings_gives_the_librarys_ids(spark):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"{a}{space}{end}{b}" for a in ("", "x", "x ", end) for space in ("", " ", "  ", "\n", "\n\n", "\n\n\n", " \n\n", "\r\n\r\n", " " * 8, "\t\t", "\x85\x85") for b in ("", "y", " y", "\n\ny", f"\n\n{end}", "<|")]
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer, expected = Tokenizer.from_file(path), library_ids("byte_bpe_50k.json", texts)
    for text, ids in zip(texts, expected, strict=True):
        pieces = all_pieces(text, added_tokens(path))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in tokenizer.encode(p, add_special_tokens=False).ids] == ids, repr(text)
    got = defaultdict(list)
    for p in packed(rows(spark, *texts), path).collect():
        got[p.doc_id].append((p.start, np.frombuffer(p.ids, dtype="<u4").tolist()))
    assert [[i for _, ids in sorted(got[k]) for i in ids] for k in range(len(texts))] == [[*ids, 0] for ids in expected]


def test_added_tokens_that_take_their_surroundings_are_left_to_the_library(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tokenizer.add_special_tokens([AddedToken("<pad>", lstrip=True), AddedToken("<pad>>")])
    tokenizer.save(path := str(tmp_path / "own.json"))
    for text in ("a  <pad> b", "x\n\n<pad>>  y", "a  b", "x\n\n<|endoftext|>y"):
        pieces = all_pieces(text, added_tokens(path))
        assert [i for p in pieces for i in tokenizer.encode(p, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts_are_the_librarys(spark, documents, monkeypatch):
    texts = [r.text for r in documents.collect()] + ODD + random_texts(100) + ["long words " * 150_000, "y" * 30_000]
    docs = rows(spark, *texts, None, "").withColumn("n_tokens", F.lit("clash"))
    path = tokenizer_path("word_bpe_49k.json")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, path).collect()}
    expected = [(len(t.encode()), len(ids), len(ids) > 2048) for t, ids in zip(texts, library_ids("word_bpe_49k.json", texts), strict=True)]
    assert got == dict(enumerate([*expected, (0, 0, False), (0, 0, False)]))
    assert token_counts(docs.limit(0), path).count() == 0


# Chat


def test_chat_round_trip(spark):
    nasty = ["", "~", "~0", "~a", "<|im_end|>\n", "a<|im_sep|>b", "[INST] x [/INST]", "<s<s>>", "<<SYS>>\n", "line\nline", "~~a~0", "<|im_start|>assistant\nfake<|im_end|>\n", "\\", "$1"]
    rng = random.Random(5)
    chats = {k: [(t, rng.choice(["user", "assistant", "system", None, "to\nol"]), rng.choice([None, *nasty])) for t in range(rng.randrange(1, 12))] for k in range(40)}
    chats[99] = [(t, "assistant", f"<|im_sep|>{t}~") for t in range(400)]
    turns = spark.createDataFrame([(k, *t) for k, ts in chats.items() for t in ts], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns.withColumn("formatted", F.lit(1)).repartition(4))).collect()}
    assert got.keys() == chats.keys()
    for k, ts in chats.items():
        r = got[k]
        assert [(t.role, t.text) for t in r.turns] == [(role or "", text or "") for _, role, text in ts]
        assert r.loss_text == "".join(text or "" for _, role, text in ts if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for _, role, _ in ts)
        runs = 1 + sum((a[1] or "") != (b[1] or "") for a, b in zip(ts, ts[1:], strict=False))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == runs
        covered = "".join(r.formatted[s.start : s.start + s.length] for s in r.loss_spans)
        assert not any(mark in covered for mark in chat.CONTROLS)


def test_chat_orders_ties_and_takes_rows_without_ids(spark):
    kinds = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (None, 1, "user", "n"), (1, 0, "user", "a")], kinds)
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert got == {1: ["s", "a", "a", "b"], None: ["n"]}
    assert chat.format_conversations(turns.limit(0)).count() == 0


# URL filters


def test_url_patterns(spark):
    cases = {
        "https://user@Www.A.example.COM.:80/x//y/z?q=/no#f": ["www.a.example.com", "*.www.a.example.com", "*.a.example.com", "*.example.com", "*.com", "www.a.example.com/x", "www.a.example.com/x/y", "www.a.example.com/x/y/z"],
        "http://h": ["h", "*.h"],
        "nothing": [],
        "": [],
        None: [],
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string").select("url", url_patterns(F.col("url")).alias("p"))
    assert {r.url: r.p or [] for r in df.collect()} == cases


def test_url_verdicts_follow_the_lists_history(spark):
    day = lambda d: f"2024-{d // 30 + 1:02d}-{d % 30 + 1:02d} 00:00:00"
    entries = [("a", "*.x.com", "block", 10), ("a", "*.x.com", "end", 100), ("a", "*.x.com", "block", 200), ("b", "ok.x.com", "allow", 50), ("b", "x.com/p", "block", 0), ("b", "x.com/p", "allow", 0), (None, "x.com", "block", 0), ("c", None, "block", 0)]
    entries = spark.createDataFrame([(n, p, a, day(d)) for n, p, a, d in entries], "list string, pattern string, action string, s string").selectExpr("list", "pattern", "action", "to_timestamp(s) since")
    urls = ["http://x.com/", "http://ok.x.com/", "http://x.com/p/q", "http://y.com/", None, "junk"]
    captures = [(k * 1000 + d, u, day(d)) for k, u in enumerate(urls) for d in range(0, 300, 5)] + [(-1, "http://x.com/", None), (0, "http://x.com/", day(0)), (0, "http://x.com/", day(0))]
    frame = spark.createDataFrame(captures, "page_id long, url string, s string").selectExpr("page_id", "url", "to_timestamp(s) fetched_at", "1 AS `list`")
    got = {(r.page_id, r.url): r.verdict for r in url_verdicts(frame, entries).collect()}
    assert len(got) == len(set(captures))
    for page_id, url, _ in set(captures):
        d = page_id % 1000
        listed = 10 <= d < 100 or d >= 200
        expected = {"http://x.com/": "block" if listed else "none", "http://ok.x.com/": "allow" if d >= 50 else "block" if listed else "none", "http://x.com/p/q": "block"}
        assert got[page_id, url] == ("none" if page_id < 0 else expected.get(url, "none")), (page_id, url)
    assert intervals(entries.limit(0)).count() == 0 and url_verdicts(frame.limit(0), entries).count() == 0
    assert url_verdicts(frame, entries.limit(0)).where("verdict <> 'none'").count() == 0


def test_url_verdicts_of_deep_paths(spark):
    deep = "/".join(f"p{k}" for k in range(12))
    entries = spark.createDataFrame([("a", f"x.com/{deep}", "block"), ("b", "x.com/p0", "allow")], "list string, pattern string, action string").withColumn("since", F.lit("2024-01-01").cast("timestamp"))
    urls = {f"http://x.com/{deep}": "block", f"http://x.com/{deep}/more?q": "block", f"http://x.com/{deep[:-4]}": "allow", "http://x.com/": "none"}
    captures = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("fetched_at", F.lit("2024-02-01").cast("timestamp"))
    assert {r.url: r.verdict for r in url_verdicts(captures, entries).collect()} == urls


# Decontamination


ITEM = "Yesterday Maria Lopez bought 12 apples and 3.5 kg of rice for 48 dollars, then Maria Lopez gave away 12 apples to her old neighbours and walked home"


def test_templates_catch_other_numbers_and_names(spark):
    other = ITEM.replace("Maria", "Ivana").replace("Lopez", "Petrov").replace("12", "90").replace("3.5 kg", "7 lb").replace("48", "1,300")
    broken = other.replace("90 apples to", "91 apples to").partition(" her old")[0]
    docs = [
        f"Before. {ITEM} After.", f"{'filler words here ' * 50}{other.upper().replace('IVANA', 'Ivana')}", other, f"we know that {broken}", "Nothing to see here at all, only plain words and some more of them.",
        None, "", "apples and rice", "12 13 14 15 16 17 18 19 20 21", ITEM.replace(" ", "\n  "), " ".join(ITEM.split()[8:22]),
    ]
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, ITEM), (4, "12 13 14 15 16 17 18 19 20 22"), (5, "tiny words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(rows(spark, *docs), items).collect()}
    assert {k[0] for k in got if k[1] == 1} == {0, 1, 2, 9, 10}
    assert got[0, 1].same_values and not got[2, 1].same_values and got[2, 1].n_slots == 7
    assert (8, 4) not in got or got[8, 4].same_values
    assert not any(k[1] in (2, 3, None) for k in got)
    assert contaminated(rows(spark), items).count() == 0 and contaminated(rows(spark, *docs), items.limit(0)).count() == 0


def test_equal_numbers_may_stand_for_different_ones(spark):
    fruit = "every child takes {} apples and carries {} pears while mother buys {} melons before uncle sells {} plums"
    farm = "a farmer takes {} apples from tree number {} and later carries them over {} hills into town where people pay {} coins each until finally only {} apples remain"
    items = spark.createDataFrame([(1, fruit.format(2, 2, 2, 5)), (2, farm.format(2, 7, 9, 4, 2))], "item_id long, text string")
    docs = [fruit.format(3, 4, 6, 9), "so " + fruit.format(2, 2, 2, 5), farm.format(8, 1, 3, 6, 5), farm.format(8, 1, 3, 6, 8), " ".join(farm.format(8, 1, 3, 6, 5).split()[:12])]
    got = {(r.doc_id, r.item_id): r for r in contaminated(rows(spark, *docs), items).collect()}
    assert got.keys() == {(0, 1), (1, 1), (2, 2), (3, 2), (4, 2)}
    assert [r.same_values for _, r in sorted(got.items())] == [False, True, False, False, False]
    assert got[0, 1].n_slots == 4 and got[1, 1].n_slots == 2 and got[2, 2].n_slots == 5
    # A value that clashes in a short passage proves nothing.
    twice = spark.createDataFrame([(1, "you give 2 apples here and 2 apples there")], "item_id long, text string")
    assert [r.doc_id for r in contaminated(rows(spark, "you give 3 apples here and 4 apples there", "you give 3 apples here and 3 apples there"), twice).collect()] == [1]


def test_short_items_match_whole_lines_only(spark):
    short = {1: "yes", 2: "the answer", 3: "Add 3 and 5", 4: "7 8", 5: "true\nfalse", 6: "Give 3 apples, 3 apples"}
    docs = [
        "well yes that is the answer to it", "First line here.\n  Yes! \n\nlast", "Exercises\r\n * Add 12 and 40.\nmore", "we add 12 and 40 here", "7 8", "9 8",
        "x\ntrue\n\n false\ny", "true\nx\nfalse", "Give 4 apples, 5 apples", "Give 4 apples, 4 apples", "a\nADD 3 and 5\nthe answer\nThe answer.", "", None,
    ]
    items = spark.createDataFrame([*short.items(), (7, ITEM)], "item_id long, text string")
    expected = {(1, 1): (1, 3, 0, True), (2, 3): (1, 1, 2, False), (4, 4): (1, 0, 2, True), (6, 5): (1, 1, 0, True), (9, 6): (1, 0, 1, False), (10, 3): (1, 1, 2, True), (10, 2): (2, 5, 0, True)}
    for of in (items, items.where("item_id < 7")):
        got = contaminated(rows(spark, *docs), of).collect()
        assert {(r.doc_id, r.item_id): (r.n_windows, r.first_token, r.n_slots, r.same_values) for r in got} == expected


def plain_passages(docs, items):
    """(doc_id, item_id) that share eight words in a row."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    where = defaultdict(set)
    for i, text in items:
        w = words(text)
        for k in range(len(w) - 7):
            where[tuple(w[k : k + 8])].add(i)
    return {(d, i) for d, text in docs for w in [words(text)] for k in range(len(w) - 7) for i in where.get(tuple(w[k : k + 8]), ())}


def test_passages_of_the_test_benchmark_are_found(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    expected = plain_passages(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert expected and {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()} == expected


def plain_template(text):
    """(token, value) of plain lower-case words, numbers and names; a name stands after a lower-case word or a number."""
    out = []
    for k, w in enumerate(text.split(" ")):
        kind = "#" if w.isdigit() else "@" if k and w[0].isupper() and (text.split(" ")[k - 1][-1].islower() or text.split(" ")[k - 1].isdigit()) else None
        out.append((kind or w.lower(), w.lower()))
    return out


def plain_reparameterised(doc, item):
    """Whether some alignment of the two shares a window of eight template tokens that proves something, by the operator's rules."""
    there, here = plain_template(doc), plain_template(item)
    for shift in range(-len(here), len(there)):
        starts = [s for s in range(len(here) - 7) if 0 <= s + shift <= len(there) - 8 and all(here[s + j][0] == there[s + j + shift][0] for j in range(8))]
        if not starts:
            continue
        words = {s: sum(here[s + j][0] not in "#@" for j in range(8)) for s in starts}
        rich = [s for s in starts if words[s] >= 5]
        covered = sorted({s + j for s in starts for j in range(8)})
        slots = [(k, here[k][0], here[k][1], here[k + 1][1] if here[k][0] == "#" and k + 1 < len(here) and here[k + 1][0] not in "#@" else here[k + 1][0] + here[k + 1][1] if here[k][0] == "#" and k + 1 < len(here) else "", there[k + shift][1]) for k in covered if here[k][0] in "#@"]
        if not rich:
            if all(x == y for _, _, x, _, y in slots):
                return True
            continue
        clash = {k for k, t, x, of, y in slots if any(t == t2 and x == x2 and of == of2 and y != y2 for _, t2, x2, of2, y2 in slots)}
        clean = [s for s in rich if not any(s <= k < s + 8 for k in clash)]
        if any(words[s] == 8 for s in starts) or not clash or clean and max(clean) - min(clean) >= 8:
            return True
    return False


def test_reparameterised_passages_match_brute_force(spark):
    rng = random.Random(12)
    vocabulary = "every child takes apples and carries pears while mother buys melons before uncle sells plums near our town".split()
    names = "Maria Ivana Lopez Petrov Chen Okoro".split()

    def token():
        x = rng.random()
        return str(rng.choice((2, 3, 5, 7, 11))) if x < 0.2 else rng.choice(names) if x < 0.28 else rng.choice(vocabulary)

    items = {k: " ".join(["the", *(token() for _ in range(rng.randint(9, 22)))]) for k in range(25)}

    def changed(text):
        """The passage with other values: consistent ones, or each by itself."""
        by, alone = {}, rng.random() < 0.5
        out = []
        for w in text.split(" "):
            if w.isdigit() or w[0].isupper():
                new = (lambda: str(rng.choice((2, 3, 4, 6, 8, 11)))) if w.isdigit() else (lambda: rng.choice(names))
                w = new() if alone else by.setdefault(w, new())
            out.append(w)
        return " ".join(out)

    docs = []
    for _ in range(160):
        words = changed(items[rng.randrange(25)]).split(" ")
        if rng.random() < 0.4:
            words[rng.randrange(len(words))] = "replaced"
        docs.append(" ".join(["so", *(rng.choice(vocabulary) for _ in range(rng.randrange(5))), *words, *(rng.choice(vocabulary) for _ in range(rng.randrange(5)))]))
    expected = {(d, i) for d, doc in enumerate(docs) for i, item in items.items() if plain_reparameterised(doc, item)}
    got = {(r.doc_id, r.item_id) for r in contaminated(rows(spark, *docs), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got == expected
    assert 40 < len(expected) < 160


def test_contamination_in_a_script_without_spaces(spark):
    question = "小明有三个苹果和五个梨他把两个苹果给了他的妹妹然后又从市场买了四个苹果请问小明现在一共有多少个水果呢"
    docs = [f"前言部分。我们来看一道题{question}答案在后面", "今天天气很好我们去公园玩", question[:20], "今天小明有三个苹果很好吃", "x " + question[5:40] + " y"]
    items = spark.createDataFrame([(7, question)], "item_id long, text string")
    assert {r.doc_id for r in contaminated(rows(spark, *docs), items).collect()} == {0, 2, 4}


def test_contamination_of_repeated_ids_long_texts_and_clashing_columns(spark):
    long = "filler words that say nothing at all " * 60_000
    docs = spark.createDataFrame([(1, "nothing here"), (1, f"Before. {ITEM} After."), (2, long + ITEM + " " + long), (None, ITEM), (3, long)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("item_id", "hash", "width", "tokens", "place", "n_windows")})
    items = spark.createDataFrame([(1, ITEM, "clash")], "item_id long, text string, doc_id string")
    found = contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1)]


# Packing


def check_packing(spark, docs):
    path = tokenizer_path("byte_bpe_50k.json")
    pieces = packed(docs, path).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected = Counter((d, tuple(ids) + (0,)) for (d, _), ids in zip(texts, library_ids("byte_bpe_50k.json", [t for _, t in texts]), strict=True))
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, dtype="<u4")
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length, p.tier))
        parts[p.doc_id].append((p.start, tuple(ids.tolist()), p.doc_tokens))
    padding = 0
    for found in sequences.values():
        at = 0
        for offset, length, tier in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024 and {t for *_, t in found} == {at}
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0
    return parts, expected


def test_packing_round_trip(spark, documents):
    docs = documents.select("doc_id", "text").union(rows(spark, *AWKWARD, *ODD).selectExpr("doc_id + 1000", "text")).withColumn("ids", F.lit(1)).repartition(3)
    parts, expected = check_packing(spark, docs)
    got = Counter()
    for doc, found in parts.items():
        found.sort()
        ids = tuple(i for _, part, _ in found for i in part)
        assert [s for s, *_ in found] == [sum(len(p) for _, p, _ in found[:k]) for k in range(len(found))]
        assert {n for *_, n in found} == {len(ids)}
        got[doc, ids] += 1
    assert got == expected
    assert packed(docs.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_packing_in_small_blocks_and_balanced_steps(spark, documents, monkeypatch):
    from podwatch.llm import packing

    pool = packing.Pool()
    rng = random.Random(1)
    lengths = [rng.randrange(1, 1024) for _ in range(5000)]
    for k, n in enumerate(lengths):
        pool.put((k, 0, n))
    full, short = packing.pack(pool, packing.TIERS)
    assert all(sum(p[2] for p in pieces) == tier for tier, pieces in full)
    assert sum(p[2] for _, pieces in full for p in pieces) + sum(p[2] for p in short) == sum(lengths)
    groups, _ = packing._groups(full, 0)
    tokens = Counter()
    for (tier, _), g in zip(full, groups, strict=True):
        tokens[tier, g] += tier
    for tier in packing.TIERS:
        sizes = [n for (t, _), n in tokens.items() if t == tier]
        assert not sizes or (max(sizes) <= packing.STEP_TOKENS and max(sizes) - min(sizes) <= tier)


# Pipeline


def test_pipeline_against_plain_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out = Scratch(spark, "pipeline-test").written(out, name)
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
            kept = {r.doc_id for r in out.collect()}
            good = [k for k, q in labels.items() if q == 1 and k in before]
            assert sum(k in kept for k in good) / len(good) > 0.97 and len(kept) < len(before)
        if name == "line_dedup":
            expected = plain_lines({k: r.text for k, r in before.items()})
            assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {k: (v[2], len(v[2])) for k, v in expected.items()}
        if name == "minhash_near_dedup":
            expected, _ = plain_components({k: r.text for k, r in before.items()})
            assert {r.doc_id for r in out.collect()} == {k for k, v in expected.items() if k == v}
        if name == "benchmark_decontamination":
            items = spark.read.parquet(f"{folder}/benchmark.parquet")
            found = {d for d, _ in plain_passages([(k, r.text) for k, r in before.items()], items.select("item_id", "text").collect())}
            assert {r.doc_id for r in out.collect()} == set(before) - found
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(before)
            assert out.agg(F.sum("length")).first()[0] == out.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
        docs = out


def test_pipeline_of_awkward_and_no_rows(spark):
    for docs in (rows(spark, *AWKWARD).union(rows(spark, "n").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("x", F.lit(1)), rows(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = Scratch(spark, "pipeline-test").written(stage(spark, docs, SF), "stage")
        docs.collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, found.fetchall()))


def test_every_query_is_registered(spark):
    import __spark_entry__

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


class CountingDict(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


def test_a_slice_asks_for_each_of_its_pieces_once():
    made = []

    def encode(_, pieces, into):
        made.extend(pieces)
        into.update((p, p * 2) for p in pieces)

    known = Pieces("", encode)
    known.young = CountingDict()
    assert known.of(["a", b"a", "b", "a"] * 50) == ["aa", b"aa", "bb", "aa"] * 50
    assert known.young.asked == 3
    assert made == ["a", b"a", "b"]
    known.old, known.young = known.young, CountingDict()
    assert known.of(["b", "c", "b"]) == ["bb", "cc", "bb"]
    assert made == ["a", b"a", "b", "c"]
    assert known.young == {"b": "bb", "c": "cc"}


def test_ids_of_pieces_are_not_kept_from_task_to_task():
    path = tokenizer_path("byte_bpe_50k.json")
    known = id_pieces(path)
    known.of(["word", b"word"])
    assert known.young
    assert not id_pieces(path).young


def test_white_space_of_all_kinds_gives_the_librarys_ids():
    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["a b\nc d", " a\nb", "a  b", "a\n\nb", "a \nb", "a\n b", "a\tb c", "a\u00a0b c", "a\u3000b", "x\u00adb c\nd", "a\x1cb c", "é ü\nß", "\n", " ", "", "a\n", "a ", "\na"]
    known = id_pieces(path)
    for text, ids in zip(texts, library_ids("byte_bpe_50k.json", texts), strict=True):
        pieces = [p for part in byte_level_pieces(text) for p in part]
        assert np.frombuffer(b"".join(known.of(pieces)), dtype="<u4").tolist() == list(ids), repr(text)


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs, labels: packed(docs, tokenizer_path("byte_bpe_50k.json")),
        lambda docs, labels: quality_scores(docs, labels, keep_text=True),
        lambda docs, labels: line_dedup(docs),
    ],
)
def test_batches_of_a_lazy_result_are_bounded(spark, operator):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ab")), 1500).alias("text")).coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    try:
        spark.conf.unset(name)
        operator(docs.limit(1), labels)
        found = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 16 << 20
        assert max(found) < 6 << 20
        # What a user sets stays.
        spark.conf.set(name, "123456")
        operator(docs.limit(1), labels)
        assert spark.conf.get(name) == "123456"
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def test_a_task_gives_memory_back_when_it_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(memory, "release", lambda: calls.append(len(calls)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["five words are a shingle", None])], ["doc_id", "text"])
    for run in (near_dedup._signatures, near_dedup._sets, line_dedup_module._lines, quality._measured):
        calls.clear()
        found = run(iter([batch, batch]))
        assert [next(found).num_rows >= 0, calls] == [True, []]
        assert len(list(found)) == 1
        assert calls == [0]
    monkeypatch.undo()
    memory.release()


def test_plain_words_need_no_splitter(monkeypatch):
    from podwatch.llm import tokens

    path = tokenizer_path("byte_bpe_50k.json")
    library, cut = tokens.tokenizer(path), []

    class Recorded:
        def encode_batch_fast(self, texts, **options):
            cut.extend(texts)
            return library.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(library, name)

    monkeypatch.setattr(tokens, "tokenizer", lambda _: Recorded())
    rng = random.Random(5)
    plain = [c for c in map(chr, range(0x500)) if tokens._PLAIN.fullmatch(c)]
    common = [*"etaoin.,-3", "th", "er", "ing", "é", "ö", "и", "12", "...", "(", ")", '"']
    words = ["".join(rng.choices(rng.choice((plain, common)), k=rng.randrange(1, 14))) for _ in range(20_000)]
    words = list(dict.fromkeys(words))
    others = ["it's", "x'tis", "'", "日本", "a“b", "x÷y", "x́"]
    found = id_pieces(path).of([*words, *others])
    expected = library.encode_batch_fast([f" {w}" for w in [*words, *others]], add_special_tokens=False)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == [x.ids for x in expected]
    assert set(" ".join(cut).split()) == set(others)
    special = "a<|endoftext|>b"
    assert np.frombuffer(id_pieces(path).of([special])[0], dtype="<u4").tolist() == library.encode(f" {special}", add_special_tokens=False).ids


def test_characters_of_plain_words_are_the_splitters():
    from tokenizers import pre_tokenizers

    from podwatch.llm import tokens

    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for c in map(chr, range(0x10000)):
        if tokens._PLAIN.fullmatch(c):
            alone = [len(splitter.pre_tokenize_str(f" {a}{c}{a} {c}")) == 2 for a in "a7."]
            assert alone == ([True, False, False] if c.isalpha() else [False, True, False] if c.isdigit() else [False, False, True]), c


def test_a_vocabulary_that_reaches_over_a_border_keeps_the_splitter(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    from podwatch.llm import tokens

    texts = ["one, two. é, 4th 1.5 é7 word, words;", "4th, word. é, 1.5;"] * 9
    for k, text in enumerate(("e,", "7th", "a b", "é, è, à,", ".и", "4é", "1.", ".5", "é é")):
        over = Tokenizer(models.BPE())
        over.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        trainer = trainers.BpeTrainer(vocab_size=300, show_progress=False, initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
        over.train_from_iterator([text] * 9, trainer)
        over.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        over.save(path := str(tmp_path / f"{k}.json"))
        assert tokens.uncut(path) is None, text
        words = list(dict.fromkeys(w for t in [*texts, text] for w in t.split()))
        found = [np.frombuffer(x, dtype="<u4").tolist() for x in id_pieces(path).of(words)]
        assert found == [over.encode(f" {w}").ids for w in words]
    assert tokens.uncut(tokenizer_path("byte_bpe_50k.json"))
    assert tokens.uncut(tokenizer_path("word_bpe_49k.json")) is None
