import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from corpus_cases import LOWER, SCHEMA, odd_documents, rows, texts_by_id, words
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from feedloom.llm import language_id, lm_scoring, quality_classifier, quality_rules
from feedloom.llm import sentencepiece_codec as codec
from feedloom.llm.common import text_buffer

SF = "/root/testdata/sf0.001"


def test_merge_ids_equal_the_library():
    own, library = codec.Pieces(codec.default_model()), sentencepiece.SentencePieceProcessor(model_file=codec.default_model())
    texts = [r[1] or "" for r in rows()] + ["a  b   c    d ", " x", "日本 𝔘 ́", "thethethe the,the"]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode(text)
        assert own.decode(ids) == text


def test_unigram_paths_are_as_good_as_the_librarys(tmp_path):
    model = pb.ModelProto()
    with open(codec.default_model(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.type == 1:
            p.score = -abs(p.score) / 4000 - 0.01 if p.score > -1e8 else -30
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    own, library = codec.Pieces(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    for text in [(r[1] or "")[:2000] for r in rows()]:
        value = lambda ids: sum(library.get_score(i) for i in ids)
        mine, theirs = own.encode(text), library.encode(text)
        assert own.decode(mine) == text
        assert value(mine) == pytest.approx(value(theirs), abs=1e-3)


def test_search_commits_within_its_window():
    own = codec.Pieces(codec.default_model())
    text = "▁" + "thequickbrownfox" * 200
    seen = 0
    for piece in own.search(text):
        assert text.startswith(piece, seen)
        seen += len(piece)
    assert seen == len(text)


def test_codec_rows(spark):
    docs = odd_documents(spark)
    coded = codec.encoded(docs)
    back = {r.doc_id: r.text for r in codec.decoded(coded).collect()}
    assert back == {r[0]: r[1] for r in rows()}
    assert codec.round_trip(docs).filter("NOT exact").count() == 0
    assert codec.encoded(spark.createDataFrame([], SCHEMA)).collect() == []


def test_languages(spark):
    docs = spark.createDataFrame(
        [(i, "the cat and the dog " * 5, "en") for i in range(30)] + [(100 + i, "der Hund und die Katze " * 5, "de") for i in range(30)]
        + [(200 + i, "собака и кошка " * 5, "ru") for i in range(30)],
        "doc_id long, text string, lang string",
    )
    model = language_id.fit(docs)
    asked = [
        (1, "the dog"), (2, "und der Hund"), (3, "кошка"), (4, None), (5, ""), (6, "12 .. !!"), (7, "日本語"),
        (8, "the cat and the dog " * 20 + "der Hund und die Katze " * 10), (None, "the cat"), (1, "the dog"),
    ]
    got = language_id.identified(spark.createDataFrame(asked, "doc_id long, text string"), model, spans=True).collect()
    assert len(got) == len(asked)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 4, 5, 6)] == ["en", "de", "ru", "und", "und", "und"]
    assert by_id[4].score == 0 and by_id[7].lang_pred in model.languages
    assert by_id[8].lang_pred == "en" and 0.5 < by_id[8].score < 0.8
    assert [s.lang for s in by_id[8].spans] == ["en", "de"]
    assert by_id[8].spans[0].start == 0 and by_id[8].spans[1].end == len(asked[7][1].rstrip())
    assert language_id.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = language_id.identify(odd_documents(spark), F.lit(False))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_languages_of_every_script(spark):
    """Scripts beyond the listed blocks are told, and letters of a script that nothing uses stay unknown."""
    texts = {
        "am": "ሰላም ለዓለም ቋንቋ", "bn": "আমার সোনার বাংলা আমি", "gu": "ગુજરાતી ભાષા છે", "ka": "ქართული ენა არის", "km": "ភាសា ខ្មែរ",
        "lo": "ພາສາ ລາວ", "my": "မြန်မာ ဘာသာ", "pa": "ਪੰਜਾਬੀ ਭਾਸ਼ਾ", "si": "සිංහල භාෂාව", "ta": "தமிழ் மொழி ஆகும்", "te": "తెలుగు భాష", "ff": "𞤆𞤵𞤤𞤢𞤪 𞤀𞤁𞤂𞤢𞤃",
    }
    rows = [(i, "the cat and the dog", "en") for i in range(200)]
    rows += [(1000 + i, text, name) for i, (name, text) in enumerate(sorted(texts.items()))]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [r[:2] for r in rows[199:]] + [(1, "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ"), (2, "the 1º dog"), (3, "🙂 𝐗"), (4, "த the")]
    got = {r.doc_id: r for r in language_id.identified(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert {i: (got[i].lang_pred, got[i].score) for i, _, name in rows[200:]} == {i: (name, 1.0) for i, _, name in rows[200:]}
    assert got[1].lang_pred == "en" and got[1].score == pytest.approx(200 / 212)
    assert got[2].lang_pred == "en" and got[4].score == 0.75


def test_every_labelled_language_is_learned(spark):
    rows = [(1000 * k + i, f"{chr(97 + k % 26)}{chr(97 + k // 26)}zu " * 5, f"l{k:03d}") for k in range(200) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert got == {i: name for i, _, name in rows}


def test_spans_of_later_rows(spark):
    """Places count from the begin of their own text, whichever texts are judged beside it."""
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, "кошка и", "ru")], "doc_id long, text string, lang string").coalesce(1)
    got = language_id.identify(docs, spans=True).collect()
    assert [(r.doc_id, [(s.start, s.end, s.lang) for s in r.spans]) for r in got] == [(1, [(0, 7, "en")]), (2, [(0, 13, "ru")])]


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(5)
    from itertools import product

    scores = draw.normal(size=(5, 3)).astype(np.float32)
    got = language_id.viterbi(scores, np.array([0]), np.array([5]), 0.7)
    value = lambda path: sum(scores[i, k] for i, k in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))
    assert value(got.tolist()) == pytest.approx(max(value(p) for p in product(range(3), repeat=5)), abs=1e-5)


def test_language_of_held_out_documents(spark):
    found = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = language_id.identify(found, ~held).alias("g").join(found.select("doc_id", "lang"), "doc_id").filter(held)
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.9


def test_quality_rules_equal_sql(spark):
    docs = odd_documents(spark)
    got = quality_rules.judged(docs, min_docs=10).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    cursor = con.execute(quality_rules.ORACLE)
    names = [d[0] for d in cursor.description]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([tuple(r[n] for n in names) for r in got.collect()], key=key) == sorted(cursor.fetchall(), key=key)
    assert quality_rules.judged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_frequent_lines_go_and_copies_stay(spark):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    docs = [(i, f"{body(i)}\nAll  rights reserved\n{body(i + 1000)}", "en", "h", 0) for i in range(30)]
    docs += [(100 + i, body(5000), "en", "h", 0) for i in range(20)]
    docs += [(300, "All rights reserved\n" * 30, "en", "h", 0)]
    kept = {r.doc_id: r for r in quality_rules.cleaned(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert kept[3].text == f"{body(3)}\n{body(1003)}" and kept[3].n_chars == len(kept[3].text)
    assert all(100 + i in kept for i in range(20)) and kept[100].text == body(5000)
    assert 300 not in kept


def test_a_line_goes_from_small_and_large_hosts_alike(spark):
    docs, wanted = [], set()
    for host, size in (("small", 60), ("middle", 200), ("large", 2000)):
        for i in range(size):
            body = " ".join(f"{host}{i}x{k}" for k in range(55))
            extra = "\nSubscribe to our letter" * (i % 6 == 0 and i < 60) + "\nSeen nine times" * (i < 9)
            docs.append((len(docs), body + extra, host))
            wanted.add(body + "\nSeen nine times" * (i < 9))
    got = quality_rules.cleaned(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    assert {r.text for r in got.collect()} == wanted


def test_unigram_and_mixer(spark):
    docs = odd_documents(spark)
    got = {r.doc_id: r for r in lm_scoring.scored(docs, F.col("doc_id") % 2 == 1, top_words=5).collect()}
    assert len(got) == len(texts_by_id()) + 1
    tokens = lambda t: words(t.translate(LOWER)) + [None]
    counts = Counter()
    for r in rows():
        if r[0] is not None and r[0] % 2 == 1:
            counts.update(tokens(r[1] or ""))
    total, distinct = sum(counts.values()), len(counts)
    for name, text in texts_by_id().items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(text))
        assert (got[name].n_tokens, got[name].train_tokens) == (len(tokens(text)), total)
        assert got[name].n_known == sum(counts[w] > 0 for w in tokens(text))
        assert got[name].base_score == pytest.approx(base, rel=1e-9)
        assert got[name].score < 0 and got[name].bits_per_byte > 0
    assert got[1].score == got[2].score and got[1].score / got[1].n_tokens > got[12].score / got[12].n_tokens
    assert lm_scoring.scored(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_mixer_is_a_distribution(spark):
    """The costs of all bytes that may follow a text add up to one."""
    docs = spark.createDataFrame([(i, "the cat sat on the mat " * 20) for i in range(9)], "doc_id long, text string")
    counts, _ = lm_scoring.gathered(docs)
    nothing = lm_scoring.Blend(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, np.zeros(16))
    mixer = lm_scoring.fitted(counts, nothing, lm_scoring.words_of(docs.limit(3).toArrow().column("text")))
    start = np.frombuffer(b"the c", np.uint8)
    total = 0.0
    for byte in range(256):
        stream = np.append(start, np.uint8(byte))
        total += math.exp(-mixer.cost(stream, lm_scoring.contexts(stream, np.zeros(len(stream), int)))[-1])
    assert total == pytest.approx(1, abs=1e-3)
    # so they do by weights that the text before has refined
    before = np.frombuffer(b"the mat the mat xx the mat " * 8, np.uint8)
    own, total = lm_scoring.Refined(1, 3), 0.0
    mixer.cost(before, lm_scoring.contexts(before, np.zeros(len(before), int)), own, np.zeros(len(before), int))
    own.step(0.25)
    assert np.abs(own.moved).max() > 0
    for byte in range(256):
        stream = np.append(before, np.uint8(byte))
        slots = lm_scoring.contexts(stream, np.zeros(len(stream), int))
        total += math.exp(-mixer.cost(stream, slots, own, np.zeros(len(stream), int))[-1])
    assert total == pytest.approx(1, abs=1e-3)


def test_weights_and_shares_are_fitted_on_all_training_texts(spark, monkeypatch):
    """No text is left out for its length or for the number of others, and tasks add up to what one would count."""
    texts = [" ".join(f"w{(i * k) % 37} plain{k % 5}" for k in range(8)) for i in range(400)]
    texts += ["a long text with common words " * 1200, "", " \t ", "日本語 テキスト"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    tallies = []
    real = lm_scoring.shares
    monkeypatch.setattr(lm_scoring, "shares", lambda tally, *rest: tallies.append(tally) or real(tally, *rest))
    assert lm_scoring.scored(docs, F.col("doc_id") % 10 != 0, top_words=20).count() == len(texts)
    learned = [words(t) for i, t in enumerate(texts) if i % 10]
    assert tallies[0].words.sum() == sum(map(len, learned))
    assert tallies[0].bits[0].sum() == sum(len(w.encode()) + 1 for t in learned for w in t)
    counts, _ = lm_scoring.gathered(docs)
    blends = [lm_scoring.Blend(np.zeros(0, np.int64), np.zeros(0, np.int64), 9000, 400, np.zeros(16)) for _ in range(2)]
    apart = lm_scoring.fitted(counts, blends[0], docs)
    alone = lm_scoring.fitted(counts, blends[1], lm_scoring.words_in(*text_buffer(pa.array(texts))))
    assert (apart.weights == alone.weights).all() and (blends[0].odds == blends[1].odds).all()
    assert np.abs(apart.weights - lm_scoring.solved(np.zeros((len(apart.weights), *tallies[0].bits.shape[1:]), np.int64))).max() > 0


def test_equal_bytes_are_looked_up_once(spark):
    """Bytes with the same slots are one group, whose branches give what every byte for itself would."""
    texts = ["the cat sat on the mat and the dog sat on the log " * 40, "", "a 日本語 " * 30, "x"]
    words = lm_scoring.words_in(*text_buffer(pa.array(texts)))
    stream, _, slots, begins = words.stream()
    assert all((a == b).all() for a, b in zip(slots, lm_scoring.contexts(stream, begins)))
    counts, _ = lm_scoring.gathered(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    blend = lm_scoring.Blend(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, np.zeros(16))
    mixer = lm_scoring.fitted(counts, blend, words)
    found = lm_scoring.alike(stream, slots, mixer.length)
    different = set(zip(*(s.tolist() for s in slots), stream.tolist()))
    assert sorted(found.order.tolist()) == list(range(len(stream))) and found.counts.sum() == len(stream)
    assert len(different) <= len(found.first) <= len(different) + 1 < len(stream) / 10
    gates, cost = mixer.gates(slots), mixer.cost(stream, slots)
    for i in range(0, len(stream), 7):
        wanted = 0.0
        for depth in range(mixer.length[stream[i]]):
            x = [float(t[int(s[i]) * 256 + mixer.nodes[depth, stream[i]]]) for t, s in zip(mixer.tables, slots)]
            z = float(np.dot(mixer.weights[depth, gates[i]].astype(float), [*x, 1.0]))
            wanted += math.log1p(math.exp(-z * mixer.bits[depth, stream[i]]))
        assert cost[i] == pytest.approx(wanted, rel=1e-4, abs=1e-5)


def test_parts_of_a_chunk_are_of_no_account(monkeypatch):
    texts = pa.array(["the cat sat on the mat " * 30, "", "日本語 the mat " * 20, "the"])
    length = np.arange(256, dtype=np.uint8) % 9 + 1
    found = []
    for size in (7, 100_000):
        monkeypatch.setattr(lm_scoring, "PART_BYTES", size)
        words = lm_scoring.words_in(*text_buffer(texts))
        stream, first, slots, begins = words.stream()
        alike = lm_scoring.alike(stream, slots, length)
        assert (np.diff(length[stream[alike.first]].astype(int)) <= 0).all()
        found.append([words.row, words.keys, words.of, stream, first, *slots, begins, alike.order, alike.group, alike.first])
    assert all((a == b).all() for a, b in zip(*found))
    empty = lm_scoring.words_in(*text_buffer(pa.array(["", " "])))
    assert [len(x) for x in (empty.keys, *empty.stream()[:2])] == [0, 0, 0]


def test_blocks_of_bytes():
    sizes = np.bincount(lm_scoring.byte_blocks(np.arange(20_000)))
    assert sizes[:9].tolist() == [64, 128, 256, 512, 1024, 2048, 4096, 4096, 4096] and sizes.sum() == 20_000


def test_weights_are_refined_within_each_text_alone(spark):
    """A text unlike the others gets cheaper by its own refinements; what stands beside it in the batch is of no account."""
    odd = (7, " ".join(f"{k}zq{k % 3}" for k in range(400)))
    common = [(100 + i, " ".join(f"plain{(i * k) % 31} word" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame([*common, odd, (8, odd[1] + " plain1")], "doc_id long, text string")
    learn = F.col("doc_id") >= 100
    plain = {r.doc_id: r.score for r in lm_scoring.scored(docs, learn, damping=0).collect()}
    got = {r.doc_id: r.score for r in lm_scoring.scored(docs, learn).collect()}
    assert got[7] > plain[7] + 1
    alone = {r.doc_id: r.score for r in lm_scoring.scored(docs.filter("doc_id <> 8"), learn).collect()}
    assert got[7] == pytest.approx(alone[7], rel=1e-5)


def test_rare_words_count_as_wholes(spark):
    """With a text's share left as fitted, it is of no account which words' counts go with the tasks."""
    docs = odd_documents(spark)
    few, many = (
        {r.doc_id: r.score for r in lm_scoring.scored(docs, F.col("doc_id") % 2 == 1, top_words=n, step=0.0).collect()} for n in (3, 10_000)
    )
    assert few.keys() == many.keys()
    for name in few:
        assert few[name] == pytest.approx(many[name], rel=1e-5)


def test_quality_classifier(spark):
    good = [(i, " ".join(f"plain{(i * 7 + k) % 50} words" for k in range(80))) for i in range(60)]
    bad = [(100 + i, " ".join(f"LOUD{(i + k) % 9}!! $$$" for k in range(80))) for i in range(60)]
    odd = [(1000, None), (1001, ""), (1002, "x" * 300_000), (None, "plain words"), (0, good[0][1])]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, labels, F.col("doc_id") % 4 != 2).collect()
    assert len(got) == 125 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by_id = {r.doc_id: r.score for r in got}
    held = [i for i in range(60) if i % 4 == 2]
    assert min(by_id[i] for i in held) > max(by_id[100 + i] for i in held)
    assert by_id[1000] == by_id[1001]
    assert quality_classifier.classify(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality_classifier.classify(docs, labels.filter("quality = 1")).collect()} == {1.0}
