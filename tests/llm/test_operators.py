"""Every operator against a plain version, and on null, empty, long, tied, repeated and no rows."""

import hashlib
import itertools
import json
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultline.llm import (
    attention_quality,
    chat,
    collision_search,
    components,
    lattice,
    ngram_quality,
    packing,
    personal,
    sentencepiece_tokens,
    simhash,
    url_rules,
)

BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row long, rest string, fingerprint string"
RNG = random.Random(4)
WORDS = ["".join(RNG.choice("abcdeéß") for _ in range(RNG.randint(1, 7))) for _ in range(300)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if i % 9 == 8 else "") for i in range(n))


TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "One Two",
    prose(1, 40),
    prose(1, 40),
    prose(1, 40).upper(),
    prose(2, 400),
    prose(2, 399) + " changed",
    "line again\nline again\nother\n" * 30,
    "a b c d e " * 3,
    "x" * 30_000,
    "word " * 20_000,
    "  two  spaces\n\n lines \t tab <|endoftext|> it's 10,000 中文 😀 end  ",
    prose(3, 6_000),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, 7, "extra", "clash") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], 7, "extra", "clash"), (None, "lost id", 1, "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(row_id):
    return "lost id" if row_id is None else TEXTS[row_id] or ""


# --- tokens -------------------------------------------------------------------------------------


def test_sentencepiece_parity_round_trip_and_empty(spark, documents, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = sentencepiece_tokens.encode(documents, PIECES).collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(text_of(row.doc_id))
        assert row.round_trip and row.agrees
    back = sentencepiece_tokens.decode(sentencepiece_tokens.encode(documents, PIECES), PIECES).collect()
    assert all(row.text == text_of(row.doc_id) for row in back)
    assert sentencepiece_tokens.encode(nothing, PIECES).count() == 0


def _field(number, kind, value):
    head = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
    size = b"" if kind != 2 else bytes([len(value) & 127 | 128, len(value) >> 7])
    return head + size + value


def test_unigram_model_with_scores_and_byte_fallback(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", -9.0, 6) for b in range(256)]
    pieces += [(p, s, 1) for p, s in (("▁", -3.0), ("a", -2.5), ("b", -2.6), ("ab", -3.1), ("▁ab", -3.3), ("ba", -4.5), ("▁▁", -6.0))]
    model = b"".join(
        _field(1, 2, _field(1, 2, p.encode()) + _field(2, 5, struct.pack("<f", s)) + _field(3, 0, bytes([k]))) for p, s, k in pieces
    )
    model += _field(2, 2, _field(3, 0, b"\1") + _field(35, 0, b"\1")) + _field(3, 2, _field(4, 0, b"\0"))
    path = tmp_path / "unigram.model"
    path.write_bytes(model)
    codec = sentencepiece_tokens.Codec(str(path))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  éz\n") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == library.encode(texts)
    assert codec.decode(codec.encode(texts)) == texts


def test_packing_ids_match_the_tokenizers_library():
    own = Tokenizer.from_file(BYTE_MODEL)
    own.encode_special_tokens = True
    encode = packing.encoder_of(BYTE_MODEL)
    rng = random.Random(8)
    marks = [" ", "  ", "\n", "ab", "'s", ".", "!!", "12", "é", " \n", "\t", "<|endoftext|>", "中", " ", "\x1c", "😀"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 20))) for _ in range(3_000)] + [t or "" for t in TEXTS]
    texts.append(" " * 12_000 + "x")
    for text, found in zip(texts, own.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == found.ids


def test_special_tokens_in_texts_as_the_unchanged_library_gives_them(tmp_path):
    rng = random.Random(12)
    marks = [" ", "  ", "\n", "ab", "'s", ".", "é", "<|endoftext|>", "<|endoftext", "|>", "<|", "中", "\t", "<|end|>", "<|end|>x"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 14))) for _ in range(3_000)]
    texts += ["a <|endoftext|> b", "", " " * 12_000 + "<|endoftext|>x"]
    content = json.loads(open(BYTE_MODEL, encoding="utf-8").read())
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    paths = [BYTE_MODEL]
    for at, more in enumerate([{}, {"special": False}, {"lstrip": True, "rstrip": True}]):
        changed = dict(content)
        changed["added_tokens"] = content["added_tokens"] + [
            {"id": 50_257, "content": "<|end|>", **plain, **more},
            {"id": 50_258, "content": "<|end|>x", **plain},
        ]
        paths.append(str(tmp_path / f"{at}.json"))
        open(paths[-1], "w", encoding="utf-8").write(json.dumps(changed))
    for path in paths:
        encode = packing.encoder_of(path, special=True)
        for text, found in zip(texts, Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
            assert encode(text) == found.ids, (path, text)


def test_packing_query_and_pipeline_give_special_tokens_their_ids(spark, tmp_path):
    import corpus_pipeline
    from vaultline.llm import queries

    frame = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    want = zlib.crc32(np.array([64, 220, 50256, 275, 1], "<u4").tobytes())
    for found in (queries.op10_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, frame, str(tmp_path))):
        assert [(r.doc_tokens, r.ids_crc32) for r in found.collect()] == [(5, want)]


# --- packing ------------------------------------------------------------------------------------


def check_packing(rows, ids):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append(row)
        by_doc.setdefault(row.doc_id, []).append(row)
    for doc, pieces in by_doc.items():
        starts = Counter((p.start, p.length, p.ids_crc32) for p in pieces)
        copies = {starts[key] for key in starts}
        assert len(copies) == 1  # a repeated row is packed as often as it occurs
        at = 0
        for start, length, crc in sorted(starts):
            assert start == at and zlib.crc32(np.array(ids[doc][start : start + length], "<u4").tobytes()) == crc
            at += length
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= packing.WINDOW


def test_packing_covers_every_id_once(documents, nothing):
    encode = packing.encoder_of(BYTE_MODEL)
    rows = packing.pack(documents, BYTE_MODEL).collect()
    keys = [*range(len(TEXTS)), None]
    assert {row.doc_id for row in rows} == set(keys)
    check_packing(rows, {key: encode(text_of(key)) + [1] for key in keys})
    assert packing.pack(nothing, BYTE_MODEL).count() == 0


def test_repeated_rows_are_packed_in_many_buckets(spark, monkeypatch):
    tables = {}

    def kept(frame, name, *more, keep=packing.keep):
        tables[name] = keep(frame, name, *more)
        return tables[name]

    monkeypatch.setattr(packing, "keep", kept)
    frame = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    rows = packing.pack(frame.repartition(3), BYTE_MODEL).collect()
    ids = packing.encoder_of(BYTE_MODEL)("same text") + [1]
    check_packing(rows, {None: ids})
    assert len(rows) == 400
    many = [row.many for row in tables["counts"].collect()]
    assert sum(many) == 400 and max(many) < 120  # of eight buckets


@pytest.mark.parametrize("counts", [{1500: 1000}, {1: 5}, {2047: 3, 1: 2}, {n: 1 + n % 7 for n in range(1, 2048)}, {700: 10, 1100: 1}, {}])
def test_plan_places_every_rest_once_with_little_padding(counts):
    table = np.zeros(packing.WINDOW, dtype=np.int64)
    for n, many in counts.items():
        table[n] = many
    plan = packing.plan_of(table)
    used = Counter()
    filled = Counter()
    for length, start, stop, first, many, sequence, offset in plan.rows:
        for k in range(many):
            used[length, first + k] += stop - start
            filled[sequence + k] += stop - start
    assert used == {(n, rank): n for n, many in counts.items() for rank in range(many)}
    assert len(filled) == plan.sequences and max(filled.values(), default=0) <= packing.WINDOW
    total = sum(filled.values())
    assert plan.sequences * packing.WINDOW <= 1.06 * total + packing.WINDOW


def test_least_squares_reaches_counts_that_combinations_can_make():
    table = np.zeros(packing.WINDOW, dtype=np.int64)
    table[[500, 1548, 1024, 100, 924]] = [90, 90, 130, 40, 40]
    rows = packing.combinations_of(table)
    x = packing.repeats(table, rows)
    used = np.bincount(rows.ravel(), weights=np.repeat(x, 3) * (rows.ravel() > 0), minlength=packing.WINDOW)
    assert (x >= 0).all() and np.abs(used - table)[1:].max() < 1


# --- near copies --------------------------------------------------------------------------------


def plain_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_against_plain_version(documents, nothing):
    rows = simhash.near_duplicates(documents).collect()
    assert len(rows) == documents.count()
    prints = {row.doc_id: row.fingerprint % 2**64 for row in rows}
    assert prints == {key: plain_print(text_of(key)) for key in prints}
    for row in rows:
        near, todo = set(), [prints[row.doc_id]]
        while todo:
            value = todo.pop()
            for other in set(prints.values()) - near:
                if (other ^ value).bit_count() <= 2:
                    near.add(other)
                    todo.append(other)
        ids = [key for key, value in prints.items() if value in near and key is not None]
        assert row.component_id == min(ids, default=None)
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("most", [0, 3, 64])
def test_links_join_the_same_groups_however_many_meet(spark, most):
    rng = random.Random(most)
    values = set()
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(30):
            values.add(value)
            for _ in range(rng.randint(1, 3)):
                value ^= 1 << rng.randrange(64)
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = {simhash._signed(v): v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = simhash.links(frame, most).collect()
    assert all((signed[a] ^ signed[b]).bit_count() <= 2 for a, b in found)
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            parent[top(a)] = top(b)
    linked = {v: v for v in values}

    def top2(v):
        while linked[v] != v:
            v = linked[v]
        return v

    for a, b in found:
        linked[top2(signed[a])] = top2(signed[b])
    groups = lambda f: {frozenset(v for v in values if f(v) == root) for root in {f(v) for v in values}}
    assert groups(top) == groups(top2)


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(70)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(71)}, **{100 + i: 100 for i in range(50)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(documents):
    kept = simhash.first_of_groups(documents)
    assert kept.columns == documents.columns
    ids = sorted(row.doc_id for row in kept.select("doc_id").collect() if row.doc_id is not None)
    groups = {row.component_id for row in simhash.near_duplicates(documents).collect() if row.component_id is not None}
    assert ids == sorted(groups)


# --- language model -----------------------------------------------------------------------------


def test_forward_recursion_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "<0xC3>", "<0xA9>"]
    model = lattice.Lattice(pieces)
    place = {p: i for i, p in enumerate(pieces)}

    def total(text):
        if not text:
            return 1.0
        ways = [p for p in pieces if not p.startswith("<") and text.startswith(p)]
        found = sum(math.exp(model.scores[place[p]]) * total(text[len(p) :]) for p in ways)
        if text[0] == "é":
            found += math.exp(model.scores[6] + model.scores[7]) * total(text[1:])
        return found

    words = ["a", "abab", "babaab", "éa", "b" * 30]
    logs = model.log_probability([w.encode() for w in words])
    assert np.allclose(logs, [math.log(total("▁" + w)) for w in words])
    uses = model.expected([b"ab"], np.array([2.0]))
    assert np.isclose(uses @ np.array([1, 2, 1, 1, 2, 2, 0, 0]), 6)  # characters of both copies


def test_lattice_words_one_by_one_or_together(monkeypatch):
    model = lattice.Lattice(lattice.read_pieces(PIECES)[0])
    words = [b"", b"a", b"nation", "h\u00e4user\u2603".encode(), b"\xff", b"abc123" * 200, *(f"word{n}".encode() for n in range(40))]
    counts = np.arange(1.0, len(words) + 1)
    alone, uses = model.log_probability(words), model.expected(words, counts)
    monkeypatch.setattr(lattice, "FEW", 0)
    assert np.allclose(alone, model.log_probability(words), rtol=1e-12)
    assert np.allclose(uses, model.expected(words, counts), rtol=1e-9, atol=1e-9)


def test_lattice_score_against_plain_counts(documents, nothing):
    rows = lattice.score(documents, PIECES).collect()
    tokens = lambda key: text_of(key).encode().lower().split() + [None]
    fold = lambda key: zlib.crc32(b"" if key is None else str(key).encode()) % 5
    counts = Counter()
    for row in rows:
        if fold(row.doc_id) != 1:
            counts.update(tokens(row.doc_id))
    total, below = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    assert len(rows) == documents.count()
    for row in rows:
        words = tokens(row.doc_id)
        assert (row.n_tokens, row.train_tokens) == (len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words) and row.held_out == (fold(row.doc_id) == 1)
        assert math.isclose(row.base_score, sum(math.log10(counts[w] + 0.5) - below for w in words), rel_tol=1e-9)
        assert row.score < 0
    assert lattice.score(nothing, PIECES).count() == 0


def test_rare_words_join_as_frequent_ones(documents, monkeypatch):
    with_table = {(r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lattice.score(documents, PIECES).collect()}
    monkeypatch.setattr(lattice, "FREQUENT_WORDS", 3)
    assert with_table == {(r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lattice.score(documents, PIECES).collect()}


# --- quality ------------------------------------------------------------------------------------


def labelled(spark, n=500):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = prose(i, 60) if good else " | ".join(w.upper() + "!!" for w in prose(i, 60).split())
        rows.append((i, text, 0, "", ""))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_plain_quality_counts(documents, nothing):
    rows = ngram_quality.judge(documents, ngram_quality.fit([], np.zeros(0))).collect()
    for row in rows:
        text = text_of(row.doc_id)
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert (row.n_words, row.word_chars) == (len(words), sum(map(len, words)))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert (row.n_dup_lines, row.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words)) and row.kept == (not row.base_failed)
    assert ngram_quality.judge(nothing, ngram_quality.fit([], np.zeros(0))).count() == 0


def test_ngram_classifier_on_held_out_rows(spark, nothing):
    documents, labels = labelled(spark)
    model = ngram_quality.train(documents, labels.where("doc_id < 300"))
    found = ngram_quality.judge(documents, model).join(labels, "doc_id").where("doc_id >= 300")
    assert found.where("kept = (quality = 1)").count() >= 0.97 * found.count()
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ngram_quality.train(nothing, empty).probability(ngram_quality.Texts.of([b"any"]))[0] > 0.9


def test_platt_scaling_is_calibrated():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=20_000) * 3
    wanted = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * scores - 1)))).astype(float)
    assert np.allclose(ngram_quality.platt(scores, wanted), (0.5, -1), atol=0.06)


def test_attention_on_held_out_rows_and_empty_texts(spark, documents, nothing):
    rows, labels = labelled(spark)
    network = attention_quality.train(rows, labels)
    held = attention_quality.fold(F.col("doc_id")) == 0
    found = attention_quality.score(rows, network).join(labels, "doc_id").where(held)
    assert found.count() > 50
    assert found.where("(score >= 0.3) = (quality = 1)").count() >= 0.95 * found.count()
    scores = [row.score for row in attention_quality.score(documents, network).collect()]
    assert len(scores) == documents.count() and all(0 <= s <= 1 for s in scores)
    assert attention_quality.score(nothing, network).count() == 0
    assert attention_quality.train(nothing, labels.where("false")).forward(np.zeros((1, attention_quality.INPUTS)), np.zeros(1, int))[0][0] > 0.9


def test_second_filter_learns_from_documents_that_the_first_one_dropped(spark, tmp_path):
    import corpus_pipeline

    rows, labels = labelled(spark)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    held = attention_quality.fold(F.col("doc_id")) == 0
    left = rows.join(labels, "doc_id").where(held | (F.col("quality") == 1)).select(rows.columns)  # all bad ones are held out
    bad = left.join(labels.where("quality = 0"), "doc_id", "left_semi").count()
    stays = corpus_pipeline.quality_classifier(spark, left, str(tmp_path)).join(labels, "doc_id")
    assert bad > 20 and stays.where("quality = 0").count() <= 0.1 * bad
    assert stays.where("quality = 1").count() >= 0.95 * left.count() - bad


def test_attention_slopes_match_differences():
    rng = np.random.default_rng(0)
    network = attention_quality.Network()
    network.parts = [part.astype(float) + 0.1 for part in network.parts]
    x, place = rng.random((7, attention_quality.INPUTS)), np.array([0, 0, 1, 1, 1, 2, 2])
    wanted = np.array([1.0, 0.0, 1.0])

    def loss():
        p, _ = network.forward(x, place)
        return -(wanted * np.log(p) + (1 - wanted) * np.log(1 - p)).mean()

    slopes = network.slopes(x, place, wanted)
    for part, slope in zip(network.parts, slopes):
        at = tuple(rng.integers(0, n) for n in part.shape)
        part[at] += 1e-5
        up = loss()
        part[at] -= 2e-5
        down = loss()
        part[at] += 1e-5
        assert math.isclose((up - down) / 2e-5, slope[at], rel_tol=1e-3, abs_tol=1e-6)


# --- nearest vectors ----------------------------------------------------------------------------


def test_nearest_vectors_ties_and_unusable_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(rng.normal(size=(600, 16)) * rng.uniform(0.5, 2, size=(600, 1)))]
    rows += [(700 + i, rows[40][1], "copy") for i in range(30)]
    rows += [(900, None, ""), (901, [0.0] * 16, ""), (902, [float("nan")] * 16, ""), (903, [1.0, None] * 8, ""), (904, [], ""), (905, [float("inf")] * 16, "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    usable = {i: np.array(v) for i, v, _ in rows if i < 900}
    found = collision_search.nearest(frame, frame.where("vec_id % 20 = 0"), 20).collect()
    hits = total = 0
    for query in [i for i in usable if i % 20 == 0]:
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        want = sorted(((-float((v * usable[query]).sum()), i) for i, v in usable.items() if i != query))[:20]
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(math.isclose(r.score, float((usable[r.vec_id] * usable[query]).sum())) for r in own)
        hits += len({i for _, i in want} & {r.vec_id for r in own})
        total += 20
    assert hits >= 0.9 * total and {r.query_id for r in found} == {i for i in usable if i % 20 == 0}
    few = collision_search.nearest(frame.where("vec_id < 5"), frame.where("vec_id = 0"), 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert collision_search.nearest(frame.where("false"), frame, 20).count() == 0


# --- chat ---------------------------------------------------------------------------------------


def test_layouts_are_recognised_by_fingerprint(spark):
    records = [
        (1, '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}'),
        (2, '{"conversations": [{"from": "human", "value": "b"}, {"from": "gpt", "value": "c"}]}'),
        (3, '{"prompt": "d", "completion": "e"}'),
        (4, '{"output": "h", "instruction": "f", "input": "g"}'),
        (5, '{"instruction": "f", "input": "", "output": "h"}'),
        (6, '{"other": 1}'),
        (7, "no json"),
        (8, None),
    ]
    frame = spark.createDataFrame(records, "conv_id long, record string")
    turns, rest = chat.canonical_json(frame, "conv_id", "record")
    found = {}
    for row in turns.orderBy("conv_id", "turn").collect():
        found.setdefault(row.conv_id, []).append((row.role, row.text))
    assert found == {
        1: [("user", "a"), ("assistant", "")],
        2: [("user", "b"), ("assistant", "c")],
        3: [("user", "d"), ("assistant", "e")],
        4: [("user", "f"), ("user", "g"), ("assistant", "h")],
        5: [("user", "f"), ("assistant", "h")],
    }
    assert sorted(row.conv_id for row in rest.collect()) == [6, 7, 8]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, what string"))


def test_formatting_reads_back_whatever_texts_say(spark):
    template = chat.Template()
    rng = random.Random(6)
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "INST]", "\n", "é😀", "$1", "a"]
    rows = [(i // 4, i % 4, rng.choice(["user", "assistant", None, "<s>"]), "".join(rng.choice(marks) for _ in range(rng.randint(0, 9)))) for i in range(400)]
    rows += [(200, 0, "user", None), (200, 0, "user", None), (None, 1, "assistant", "x" * 50_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    turns = chat.canonical_turns(frame)
    whole = chat.conversations_text(chat.format_turns(turns, template))
    for row in whole.select("conv_id", "spans", "formatted", template.read(F.col("formatted")).alias("turns")).collect():
        want = sorted((t, r or "", x or "") for c, t, r, x in rows if c == row.conv_id)
        assert [(x.role, x.text) for x in row.turns] == [(r, x) for _, r, x in want]
        learned = [row.formatted[s.start : s.start + s.length] for s in row.spans]
        assert [re.sub(r"(?<=[<\[])(\\*)\\(?=(?:s>|/s>|INST\]|/INST\]))", r"\1", x) for x in learned] == [x for _, r, x in want if r == "assistant" and x]


# --- URL rules ----------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("org", "/fr/x", "block")]


def test_url_rules_against_plain_matching(spark):
    urls = [None, "", "no scheme", "http://", "http://a.NET", "http://a.net/", "https://x.example.net/en/1?q#f", "https://example.net/en", "http://myexample.com/de/1",
            "http://example.com/de/", "http://www.Example.com/de/x#y", "http://a.b.org/fr/x", "http://org/fr/", "http://a.org?x=/fr/", "http://" + "a." * 3000 + "net/" + "p/" * 3000, "http://a.net//x\ny", "http://a.net/"]
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)], "page_id long, url string, rule string, verdict string")
    rows = url_rules.judge(pages, spark.createDataFrame(RULES + RULES[:2], "host string, path string, verdict string")).collect()
    assert len(rows) == len(urls)
    for row in rows:
        url = urls[row.page_id] or ""
        _, found, rest = url.partition("://")
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0] if found else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host) if found else ""
        fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        assert (row.host, row.path) == (host, path)
        assert (row.rule, row.verdict) == ((best[0] + best[1], best[2]) if best else (None, "allow"))
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(pages, none, "block").collect()} == {"block"}


# --- personal data ------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            n = int(c) * (2 if i % 2 else 1)
            total += n - 9 * (n > 9)
        return total % 10 == 0

    tests = {
        "email": lambda m: True,
        "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m)),
        "phone": lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15,
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text) if tests[k](m[0])]


def test_personal_spans_against_plain_patterns(spark, nothing):
    rng = random.Random(9)
    marks = ["a@b.c", "x.y_z@mail-1.example.com", "@", ".", "1.2.3.4", "255.256.1.1", "00000001.2.3.04", "4111 1111-1111 1111", "4111111111111112", "+1 (499) 555-6503",
             "+1", "-", " ", "é😀", "\n", "12", "(", "_", "%"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    texts += [None, "", "7" * 60_000, "a." * 30_000, "1 " * 30_000, "1.2.3.4 " * 300, "+" + "1(" * 20_000]
    frame = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], "doc_id long, text string, sure string, spans string, kind string")
    found = personal.find(frame).select("doc_id", personal.listed(F.col("sure")).alias("sure"), personal.listed(F.col("spans")).alias("spans"))
    for row in found.collect():
        want = plain_spans(texts[row.doc_id] or "")
        assert row.sure == ",".join(want), texts[row.doc_id]
        assert set(want) <= set(filter(None, row.spans.split(",")))
    assert personal.find(nothing).count() == 0


def test_candidates_that_speak_for_themselves_are_added(spark):
    texts = [f"write to mail a{i}@b.com or call phone +1 (499) 555-65{i:02d} now" for i in range(60)]
    texts += ["please contact jane.doe (at) example (dot) com today", "call me by phone: (499) 555-0199 please", "version 2.400 no. 123.4567 of 3 items"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = dict(personal.find(frame).select("doc_id", personal.listed(F.col("spans"))).collect())
    assert rows[60] and rows[61] and not rows[62]


def test_reliabilities_follow_agreement():
    rows = [(0, (1, 1, 1, 1, 1), 500), (0, (-1, -1, -1, 0, -1), 400), (0, (1, 1, -1, 1, 1), 40), (0, (-1, -1, 1, 0, -1), 60)]
    table, belief = personal.reliabilities(rows)
    assert belief[0] > 0.95 and belief[1] < 0.05 and belief[2] > 0.8 and belief[3] < 0.2
    assert table["format"][1][0] > table["gazetteer"][1][0]


def test_redaction_keeps_all_else(spark):
    frame = spark.createDataFrame([(1, "é a@b.co, 1.2.3.4 and +1 (499) 555-6503!"), (2, "clean"), (3, "")], "doc_id long, text string")
    found = personal.find(frame, F.col("text").alias("whole"))
    rows = dict(found.select("doc_id", personal.redacted(F.col("whole"), F.col("spans"))).collect())
    assert rows == {1: "é [EMAIL], [IP] and [PHONE]!", 2: "clean", 3: ""}


def test_redaction_covers_all_of_overlapping_spans(spark):
    texts = [
        "call +1 499 555 6503.bob@x.com",
        "+49.30.1234567@fax.example.com",
        "a@b.com-4111 1111 1111 1111",
        "a@b.com-4111 1111 1111 1111, 1.2.3.4",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = personal.find(frame, F.col("text").alias("whole"))
    rows = dict(found.select("doc_id", personal.redacted(F.col("whole"), F.col("spans"))).collect())
    assert rows == {0: "call [PHONE]", 1: "[PHONE]", 2: "[EMAIL]", 3: "[EMAIL], [IP]"}


# --- the queries --------------------------------------------------------------------------------


def test_sha_of_turns_in_the_query_is_that_of_the_table(spark):
    from vaultline.llm import queries

    folder = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    rows = {row.conv_id: row for row in queries.op3_chat(spark, folder).collect()}
    for conv in {t.conv_id for t in turns}:
        own = sorted((t.turn, t.role or "", t.text or "") for t in turns if t.conv_id == conv)
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        learned = "".join(x for _, r, x in own if r == "assistant")
        assert rows[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == 21
