"""Near duplicates, neighbours, mixing, packing, token files, pipeline."""

import collections
import math
import random
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from evenkeel.llm import language, mixing, neardup, neighbours, packing, quality, secrets, shingles, tokenfiles, toxicity
from evenkeel.llm.common import new_path
from evenkeel.llm.components import connected_components
from evenkeel.llm.queries import ORACLE, QUERIES
from evenkeel.llm.tokens import PieceEncoder, encoder

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD_TEXTS = [None, "", " ", "  a  b \n c ", " x", "x ", "\n", "a\x1cb c", "don't  we'll ... ,a. É. Σ. ΑΣ. b", "a\0b c", "½. x² y",
             "a　b c\xa0d", "a ́b", "<|endoftext|> a <|startoftext|>b </w>", "\n\n a\n b.\n\n c", "word " * 5000]


def documents(spark, texts, **columns):
    rows = [(i, t, "en", columns.get("sources", ["s"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_texts():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One", "one two", "one\ttwo", "a b c", "A  b\nc"]
    for group in range(6):
        base = [draw.choice(vocabulary) for _ in range(120)]
        for _ in range(25):  # about the threshold, so that links run over several texts
            copy = list(base)
            for _ in range(draw.choice((0, 1, 2, 3))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
        chain = list(base)
        for k in range(15):
            chain[7 * k] = f"new{group}{k}"
            texts.append(" ".join(chain))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, size, percent):
    texts = near_texts()
    labels, sizes = brute_components(texts, size, percent)
    docs = documents(spark, texts).withColumn("bands", F.lit(1)).withColumn("node", F.lit("x"))
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs, size, percent).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == labels
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_drop_fewer_linked_pairs_than_bands(percent):
    share, samples, bits = percent / 100, shingles.BANDS * shingles.ROWS, shingles.SKETCH_BITS
    limit = shingles.most_odd_bits(share - neardup.SKETCH_SLACK)
    odd, k, lost = np.eye(1, bits + 1)[0], np.arange(bits + 1), 0.0
    for different in range(samples + 1):  # samples that differ, each two bits turned over
        lost += math.comb(samples, different) * (1 - share) ** different * share ** (samples - different) * odd[limit + 1:].sum()
        for _ in range(2):
            turned = np.zeros(bits + 1)
            turned[1:] += odd[:-1] * (1 - k[:-1] / bits)
            turned[:-1] += odd[1:] * k[1:] / bits
            odd = turned
    assert lost < (1 - share ** shingles.ROWS) ** shingles.BANDS


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z"), (4, "x y z"), (4, "x y z"), (5, None)],
                                 "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, 3, 85).collect()
                 if r["doc_id"] is not None)
    assert got == [(4, 4, True), (4, 4, True), (5, 5, True)]
    assert neardup.near_duplicates(docs.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(9, 9), (8, 7), (7, 8)]
    got = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect())
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in [7, 8, *range(200, 240)]} == {7}
    assert len(got) == 61 + 42


def test_neighbours_reach_recall(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 16)) * draw.uniform(0.5, 2, size=(3000, 1))
    x[5] *= 3
    x[1000:1900] = x[5]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    bad = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] + [1.0] * 15), (9003, [float("inf")] + [1.0] * 15),
           (9004, [None] + [1.0] * 15), (None, [1.0] * 16)]
    valid = neighbours.valid_vectors(spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>"))
    assert valid.count() == 3000
    found = neighbours.nearest_neighbours(valid, valid.where("vec_id % 50 = 0 or vec_id = 5")).collect()
    by = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append(r)
    exact = x.astype(np.float32).astype(float)
    hits = 0
    for q, got in by.items():
        scores = exact @ exact[q]
        scores[q] = -np.inf
        want = np.lexsort((np.arange(3000), -scores))[:20]
        assert [r["rank"] for r in got] == list(range(1, 21)) and q not in {r["vec_id"] for r in got}
        assert all(abs(r["score"] - exact[r["vec_id"]] @ exact[q]) < 1e-9 for r in got)
        hits += len({r["vec_id"] for r in got} & set(want.tolist()))
    assert hits >= 0.9 * 20 * len(by)
    assert [r["vec_id"] for r in by[1000]][:3] == [5, 1001, 1002]


@pytest.mark.parametrize("long", [1e6, 1e20])
def test_neighbours_beside_long_vectors(spark, long):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[3] *= long
    x[4] /= long
    valid = neighbours.valid_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                                           "vec_id bigint, embedding array<double>"))
    got = collections.defaultdict(set)
    for r in neighbours.nearest_neighbours(valid, valid.where("vec_id % 50 = 3 or vec_id = 4")).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in (*range(3, 1500, 50), 4):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hits >= 0.95 * 20 * 31


def test_neighbours_of_few(spark):
    few = neighbours.valid_vectors(spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0])], "vec_id bigint, embedding array<double>"))
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest_neighbours(few, few).collect()]
    assert sorted(got) == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]
    assert neighbours.nearest_neighbours(few.where("false"), few.where("false")).count() == 0


def test_neighbours_of_repeated_ids(spark):
    rows = [(20, [1.0, 0.0]), (20, [2.0, 0.0]), (20, [2.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (3, [2.0, 0.0])]
    all_rows = neighbours.valid_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    for k in (2, 20):
        got = collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest_neighbours(
            all_rows, all_rows.where("vec_id = 20"), k).collect())
        want = collections.Counter()
        for i, (name, v) in enumerate(rows[:3]):
            near = sorted((-float(np.dot(v, w)), other) for j, (other, w) in enumerate(rows) if j != i)[:k]
            want.update((name, rank, other, -score) for rank, (score, other) in enumerate(near, 1))
        assert got == want


def test_mix_takes_targets(spark, monkeypatch):
    draw = random.Random(2)
    sources = [draw.choice(["a", "a", "b", "c", "d", None]) for _ in range(600)]
    texts = [" ".join(["w", "#"][draw.random() < 0.1] for _ in range(draw.randrange(0, 60))) for _ in sources]
    texts[:3] = [None, "", "big " * 3000]
    docs = documents(spark, texts, sources=sources).withColumn("size", F.lit("x")).withColumn("mix", F.lit("y"))
    whole = {r["doc_id"]: r["mix"] for r in mixing.mix_sources(docs).collect()}
    monkeypatch.setattr(mixing, "SLICE_DOCUMENTS", 20)
    sliced = {r["doc_id"]: r["mix"] for r in mixing.mix_sources(docs).collect()}
    assert whole == sliced and len(whole) == 600
    by = collections.defaultdict(list)
    for i, s in enumerate(sources):
        by[s].append(whole[i])
    total = sum(m["size"] for m in whole.values())
    assert abs(sum(rows[0]["target"] for rows in by.values()) - total) < 1e-6 * total
    for rows in by.values():
        assert {m["source_size"] for m in rows} == {sum(m["size"] for m in rows)}
        assert abs(sum(m["taken"] for m in rows) - rows[0]["target"]) <= 1
        assert all(m["taken"] <= 3 * m["size"] for m in rows) and rows[0]["target"] <= 3 * rows[0]["source_size"] + 1e-6
    taken = mixing.mixed_documents(mixing.mix_sources(docs)).select(F.size(F.split(F.trim("text"), r"\s+")).alias("n"))
    assert taken.agg(F.sum("n")).first()[0] == sum(m["taken"] for m in whole.values())
    assert mixing.mix_sources(docs.where("false")).count() == 0


def test_cut_documents_keep_their_white_space(spark):
    texts = [" a\n\tb  c d ", "a\n\tb  c d ", "é\r\n\u00a0f g\n", "x y"]
    rows = [(t, (size, taken)) for t, size, taken in zip(texts, (4, 4, 3, 2), (7, 3, 2, 2))]
    mixed = spark.createDataFrame(rows, "text string, mix struct<size: bigint, taken: bigint>")
    assert sorted(r["text"] for r in mixing.mixed_documents(mixed).collect()) == sorted(
        [" a\n\tb  c d ", " a\n\tb  c", "a\n\tb  c", "é\r\n\u00a0f", "x y"])


def test_heavier_documents_are_drawn_first(spark):
    docs = documents(spark, ["w " * 10 + "# " * (40 * (i % 2)) for i in range(2000)])
    keyed = docs.withColumn("key", mixing.exponential_key(F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.2), "t"))
    first = keyed.orderBy("key").limit(400).where("doc_id % 2 = 0").count()
    assert first > 290  # 5 : 1


def test_first_fit_decreasing_is_first_fit():
    draw = random.Random(4)
    lengths = [draw.randrange(1, 1025) for _ in range(700)]
    room, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bin_ = next((b for b, r in enumerate(room) if r >= lengths[i]), None)
        if bin_ is None:
            room.append(1024)
            bin_ = len(room) - 1
        room[bin_] -= lengths[i]
        want[i] = bin_
    assert packing.first_fit_decreasing(lengths, 1024) == [want[i] for i in range(len(lengths))]
    assert packing.first_fit_decreasing([], 1024) == []


@pytest.mark.parametrize("path,dtype", [(BYTES, "<u4"), (WORDS, "<u2")])
def test_ids_are_those_of_whole_texts(path, dtype):
    pieces, plain = PieceEncoder(path, dtype, kept=50), Tokenizer.from_file(path)
    texts = [t for t in ODD_TEXTS if t is not None] * 2
    for text in texts:
        assert np.frombuffer(pieces.encode([text])[0], dtype).tolist() == plain.encode(text, add_special_tokens=False).ids
    together = [np.frombuffer(x, dtype).tolist() for x in PieceEncoder(path, dtype).encode(texts)]
    assert together == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert pieces.encode([]) == []


@pytest.mark.parametrize("path,dtype", [(BYTES, "<u4"), (WORDS, "<u2")])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("aAbé .,'s\n\t 1<|>\x01\x1c\u0301İΣ½一क़\u3000_-")) | st.characters(codec="utf-8"), max_size=14), max_size=6))
def test_ids_of_any_texts(path, dtype, texts):
    plain = Tokenizer.from_file(path)
    got = [np.frombuffer(x, dtype).tolist() for x in encoder(path, dtype).encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_are_the_librarys_unless_told():
    text = "x <|endoftext|> y <|EndOfText|>"
    for path in (BYTES, WORDS):
        plain = Tokenizer.from_file(path)
        ids = lambda e: np.frombuffer(e.encode([text])[0], "<u4").tolist()
        assert ids(PieceEncoder(path)) == plain.encode(text, add_special_tokens=False).ids
        assert set(ids(PieceEncoder(path))) & {50256, 49407}
        plain.encode_special_tokens = True
        assert ids(PieceEncoder(path, special_as_text=True)) == plain.encode(text, add_special_tokens=False).ids


def test_packed_pieces_cover_documents(spark, monkeypatch):
    texts = ODD_TEXTS + [f"some words {i} " * (i % 90) for i in range(300)]
    docs = documents(spark, texts).unionByName(documents(spark, texts[:5])).withColumn("ids", F.lit(1)).withColumn("group", F.lit(2))
    rows = packing.pack_documents(docs, BYTES, length=256, group_documents=64).collect()
    ids = collections.defaultdict(list)
    for r in rows:
        ids[r["doc_id"]].append((r["start"], bytes(r["ids"])))
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 256
    plain = Tokenizer.from_file(BYTES)
    for i, text in enumerate(texts):
        want = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        times = 2 if i < 5 else 1
        assert b"".join(x for _, x in sorted(ids[i])) == want or times == 2 and len(ids[i]) % 2 == 0
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(r["length"] for r in pieces[:i]) for i in range(len(pieces))]
        assert sum(r["length"] for r in pieces) <= 256
    assert packing.pack_documents(docs.where("false"), BYTES).count() == 0


def test_token_files_round_trip(spark):
    docs = documents(spark, ODD_TEXTS + ["abc " * i for i in range(200)]).withColumn("start", F.lit(1))
    folder = tokenfiles.token_folder(spark)
    files = tokenfiles.write_token_files(docs, WORDS, folder, end_id=2, length=64)
    rows = sorted(tokenfiles.read_token_files(spark, files).collect(), key=lambda r: r["doc_id"])
    plain, start = Tokenizer.from_file(WORDS), 0
    for r in rows:
        text = docs.where(F.col("doc_id") == r["doc_id"]).first()["text"] if r["doc_id"] < 20 else "abc " * (r["doc_id"] - len(ODD_TEXTS))
        want = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["start"], r["n_tokens"]) == (start, len(want)) and bytes(r["ids"]) == want.tobytes()
        start += len(want)
    assert len(rows) == len(ODD_TEXTS) + 200
    first = files.orderBy("part").first()
    sequences = tokenfiles.open_sequences(first["path"] + ".arrows")
    ids, mask = sequences[0]
    assert len(sequences) == -(-first["tokens"] // 64) and ids.shape == (64,) and len(mask) == 64 and all(mask.to_pylist())
    assert not ids.flags.owndata  # the file's own memory
    assert sum(sum(sequences[i][1].to_pylist()) for i in range(len(sequences))) == first["tokens"]
    with pytest.raises(IndexError):
        sequences[len(sequences)]
    none = tokenfiles.write_token_files(docs.where("false"), WORDS, tokenfiles.token_folder(spark), end_id=2)
    assert tokenfiles.read_token_files(spark, none).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, FOLDER).collect(), before.schema)
        assert after.columns == columns
        if name in ("quality rules", "MinHash near-dedup"):
            assert after.exceptAll(before).count() == 0 and 0 < after.count() < before.count()
        if name == "secret scans":
            assert after.count() == before.count()
            assert after.where(F.col("text").rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count() == 0
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "secret scans", "mixing sources", "packing"]


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    texts = ["a b c d e f g h"] * 5 + ["q r s t u v w x y z"] + [None, ""]
    docs = documents(spark, texts).unionByName(documents(spark, texts[:1]))
    left = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 5, 6, 7]


def test_near_duplicate_stage_decides_by_row(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    a, b, c, d = (text(n) for n in "abcd")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c + " more"), (3, c.upper()), (None, d), (None, d + " more"),
            (None, a), (None, ""), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    left = dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, docs, FOLDER)
    assert left.columns == docs.columns
    got = collections.Counter((r["doc_id"], (r["text"] or "").lower()[:2]) for r in left.collect())
    assert got == {(1, "a0"): 1, (2, "b0"): 1, (3, "c0"): 1, (None, "d0"): 1, (None, ""): 1, (4, ""): 2}


def test_query_columns(spark):
    want = {
        "op1": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", "op2": "doc_id held_out lang_pred score",
        "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op4": "query_id rank vec_id score",
        "op5": "doc_id n_shingles component_id kept", "op6": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op7": "doc_id held_out score predicted", "op8": "doc_id size source_size target taken",
        "op9": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op10": "doc_id start n_tokens ids_crc32",
        "op11": "query_id rank vec_id score", "op12": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
        "op13": "item_id rank doc_id score"}
    for name, query in QUERIES.items():
        df = query(spark, FOLDER)
        assert set(want[name.split("_")[0]].split()) <= set(df.columns), name
        assert df.count() > 0, name


def test_crc_of_pieces_is_that_of_their_ids(spark):
    row = QUERIES["op9_packing"](spark, FOLDER).where("start = 0 and length = doc_tokens").first()
    text = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.col("doc_id") == row["doc_id"]).first()["text"]
    ids = Tokenizer.from_file(BYTES).encode(text or "", add_special_tokens=False).ids + [0]
    assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


CLASHING = ("target", "open", "last", "of", "epochs", "source_size", "_id", "_source", "_text", "_lang", "_counts", "_kept", "_own", "_mark",
            "mark", "kept", "word", "slice", "_key", "a.b", "__kept_0")


def test_clashing_names_pass_through(spark):
    texts = ["the cat sat on the mat and saw a dog by the sea " * 8, "password: hunter2hunter2 " * 3, None, ""] * 2
    docs = documents(spark, texts).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    labels = spark.createDataFrame([(0, 1, 2), (1, 0, 3)], "doc_id bigint, toxic int, _toxic int")
    model = language.fit_languages(docs)
    for out in (mixing.mix_sources(docs), quality.quality_rules(docs), secrets.scan_secrets(docs), language.identify_languages(docs, model),
                toxicity.score_toxicity(docs, toxicity.fit_lexicon(docs.withColumn("_toxic", F.lit(1)), labels))):
        rows = out.collect()
        assert len(rows) == len(texts) and all(r[c] == i for r in rows for i, c in enumerate(CLASHING))
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, docs, FOLDER)
        assert name == "packing" or after.columns == docs.columns
        assert name == "packing" or all(r[c] == i for r in after.collect() for i, c in enumerate(CLASHING))
        assert step(spark, docs.where("false"), FOLDER).count() == 0


def test_stages_delete_only_what_their_own_input_was_read_from(spark):
    steps, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{FOLDER}/documents.parquet")
    written = lambda df: [path := new_path(spark, "interleaved"), df.write.parquet(path), spark.read.parquet(path)][2]
    quality_, dedup = steps["quality rules"], steps["MinHash near-dedup"]
    a, b = quality_(spark, docs, FOLDER), quality_(spark, docs, FOLDER)
    n = a.count()
    direct = dedup(spark, a, FOLDER).count()  # not written: its tables stay
    other = dedup(spark, docs, FOLDER)
    a_again = written(a)
    assert dedup(spark, a_again, FOLDER).count() == direct and b.count() == n and other.count() > 0
    with pytest.raises(Exception):
        a.count()
