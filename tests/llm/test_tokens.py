import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyboard.llm import packing, rows as shared, token_store
from tallyboard.llm.queries import tokenizer
from tallyboard.llm.tokens import ENCODE_BYTES, Encoder, _Pieces
from tallyboard.session import small_batches

TEXTS = ["", None, " ", "one", "one two  three", " lead", "trail ", "tabs\tand \n lines\n\n", "x" * 3000, "words " * 4000, "it's 12,000 cafés   wide",
         "a b <|endoftext|> c", "\x0b v \x0b", "你好 世界", "a\x85b \x85 c"]


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_columns_of_texts(ids):
    for texts in (TEXTS, TEXTS[:4], [], ["a  b"]):
        got, lengths = Encoder.of(tokenizer()).column(pa.array(texts, pa.string()))
        assert got.tolist() == [i for t in texts for i in ids(t)] and lengths.tolist() == [len(ids(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab. ,'1\n\té ", max_size=20), max_size=6))
def test_any_texts(ids, texts):
    got, _ = Encoder.of(tokenizer()).column(pa.array(texts, pa.string()))
    assert got.tolist() == [i for t in texts for i in ids(t)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x0c\x1c\x85\xa0\u2028\u3000aZstré×÷ñÀÿªµ\u0301\u0130жア好’'.,;-_<|>09²½", max_size=24), max_size=6))
def test_texts_of_many_scripts_and_spaces(ids, texts):
    """Cut beside letters of several scripts, marks, figures and every white space: as the library encodes the whole."""
    got, lengths = Encoder.of(tokenizer()).column(pa.array(texts, pa.string()))
    assert got.tolist() == [i for t in texts for i in ids(t)] and lengths.tolist() == [len(ids(t)) for t in texts]


def test_a_word_is_encoded_once_whatever_marks_and_lines_follow(ids):
    """Pieces end with the word, so words times marks are not all new pieces."""
    encoder, words = Encoder(tokenizer()), [a + b + c for a in ("ga", "ré", "tu", "lin") for b in ("mo", "ße", "kar") for c in ("st", "de", "ñi")]
    text = " ".join(f"{w}{mark}" for mark in (",", ".", "!", ";", "'s", "...", ".\nThe", "\nEt", "\n\nLa", " -") for w in words)
    assert encoder.column(pa.array([text]))[0].tolist() == ids(text)
    assert encoder.rest.ids.count < 2 * len(words)


def test_a_worker_may_begin_with_empty_texts(ids, monkeypatch):
    monkeypatch.setattr("tallyboard.llm.hashing._TABLES", {})
    encoder = Encoder(tokenizer())
    for texts in (["", None], ["", "one, two", None]):
        got, lengths = encoder.column(pa.array(texts, pa.string()))
        assert got.tolist() == [i for t in texts for i in ids(t)] and lengths.tolist() == [len(ids(t)) for t in texts]


def test_cache_starts_anew(ids, monkeypatch):
    monkeypatch.setattr("tallyboard.llm.tokens.KEEP_BYTES", 500 + (5 << 12) + (16 << 10))
    e = Encoder(tokenizer())
    for text in ("one two three four five", "six two seven", "one two"):
        assert e.column(pa.array([text]))[0].tolist() == ids(text)
    assert isinstance(e.rest, _Pieces) and e.rest.ids.count < 8


def thue_morse(n):
    """A word and its complement, which every polynomial hash modulo a power of two takes for the same."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomial_hashes_confuse(spark, docs, ids, crc, tmp_path):
    """In one worker, over batches, and in the queries' operators."""
    rows = [(i, f"x {w} y") for i, w in enumerate(thue_morse(1024) * 3)]
    encoder = Encoder(tokenizer())
    for _, text in rows:
        assert encoder.column(pa.array([text]))[0].tolist() == ids(text)
    frame = docs(*rows).coalesce(1)
    want = {i: crc([*ids(t), 2]) for i, t in rows}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        assert {r["doc_id"]: r["ids_crc32"] for r in packing.pack(frame, tokenizer(), length=10_000).collect()} == want
        token_store.write(frame, str(tmp_path / "t"), tokenizer())
        assert {r["doc_id"]: r["ids_crc32"] for r in token_store.digests(spark, str(tmp_path / "t")).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)


def test_strings_of_special_tokens(ids):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext"):
        assert Encoder.of(tokenizer()).column(pa.array([text]))[0].tolist() == ids(text)
    assert 50256 in ids("a <|endoftext|> b")


def test_kept_pieces_have_a_bound(ids, monkeypatch):
    """Ever new pieces do not grow a worker beyond what it may keep and one batch more."""
    monkeypatch.setattr("tallyboard.llm.tokens.KEEP_BYTES", 200_000)
    encoder = Encoder(tokenizer())
    for i in range(30):
        text = " ".join(f"w{i}x{k}" for k in range(500))
        assert encoder.column(pa.array([text]))[0].tolist() == ids(text)
        assert encoder.rest.bytes < 400_000


def test_hot_ids_and_stripes(spark, docs, ids, crc, tmp_path):
    """A third of all rows under one id are split over files; files have several stripes; a lookup reads few row groups."""
    import glob

    import pyarrow.orc as orc

    rows = [(i, f"text {i * 7919} number {i * 31} of all {i}") for i in range(9000)] + [(5, f"hot {i % 40} {i}") for i in range(4500)] + [(None, f"none {i % 3}") for i in range(200)]
    path = str(tmp_path / "tokens")
    token_store.write(docs(*rows), path, tokenizer(), stripe_bytes=40_000, row_group=1000, part_bytes=200_000)
    files = glob.glob(path + "/*.orc")
    holds = [set(spark.read.schema(token_store.SCHEMA).orc(f).select("doc_id").distinct().toPandas()["doc_id"].dropna()) for f in files]
    assert sum(5 in h for h in holds) > 1 and max(orc.ORCFile(f).nstripes for f in files) > 1
    got = sorted(tuple(r) for r in token_store.digests(spark, path).select("start", "n_tokens", "ids_crc32").collect())
    start = 0
    for first, n, _ in got:
        assert first == start
        start += n
    assert len(got) == len(rows) and sorted(c for _, _, c in got) == sorted(crc([*ids(t), 2]) for _, t in rows)
    assert token_store.lookup(spark, path, 2999).count() == 1 and token_store.lookup(spark, path, 5).count() == 4501


ARROW = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


@pytest.fixture
def large_batches(spark):
    """A session that hands Python 10,000 rows at a time, Spark's default."""
    before = [spark.conf.get(k) for k in ARROW]
    for k, v in zip(ARROW, ("10000", "64m")):
        spark.conf.set(k, v)
    yield ["10000", "64m"]
    for k, v in zip(ARROW, before):
        spark.conf.set(k, v)


def test_workers_get_little_at_a_time_whatever_the_session_sets(spark, docs, ids, crc, tmp_path, monkeypatch, large_batches):
    """Batches of rows, slices to encode, and the batches read back from the files are all small."""
    seen, cut, settings_then = tmp_path / "seen", token_store._batches, {}

    def noted(batches, text, *most):
        for batch in batches:
            for part in cut(iter([batch]), text, *most):
                with open(seen, "a") as f:
                    f.write(f"{len(batch)} {batch.nbytes} {part['text'].nbytes}\n")
                yield part

    def stored(*args):
        settings_then[args[1]] = [spark.conf.get(k) for k in ARROW]
        return write(*args)

    write = shared.stored
    texts = [f"some words of text {i % 7} " * 80 for i in range(2500)] + ["a longer text, " * 7000] * 60
    frame = docs(*enumerate(texts)).coalesce(1)
    monkeypatch.setattr(shared, "stored", stored)
    for operator in (token_store, packing):
        monkeypatch.setattr(operator, "_batches", noted)
    token_store.write(frame, str(tmp_path / "t"), tokenizer())
    got = {r["doc_id"]: r["ids_crc32"] for r in token_store.digests(spark, str(tmp_path / "t")).collect()}
    assert got == {i: crc([*ids(t), 2]) for i, t in enumerate(texts)}
    packed = packing.pack(frame, tokenizer())
    assert packed.select("doc_id").distinct().count() == len(texts)
    assert settings_then["token-digests"] == settings_then["pieces"] == ["1000", str(4 << 20)]
    sizes = [tuple(map(int, line.split())) for line in seen.read_text().splitlines()]
    assert max(n for n, _, _ in sizes) == 1000 and max(n for _, n, _ in sizes) < 5 << 20
    assert max(n for _, _, n in sizes) < ENCODE_BYTES + 200_000
    assert [spark.conf.get(k) for k in ARROW] == large_batches


def test_small_batches_are_given_back(spark, large_batches):
    with pytest.raises(ZeroDivisionError), small_batches(spark):
        assert spark.conf.get(ARROW[0]) == "1000"
        1 / 0
    assert [spark.conf.get(k) for k in ARROW] == large_batches
    for own, inside in (("5", "5"), ("0", "1000"), ("-1", "1000")):
        spark.conf.set(ARROW[0], own)
        with small_batches(spark):
            assert spark.conf.get(ARROW[0]) == inside
        assert spark.conf.get(ARROW[0]) == own


def test_store_round_trip(spark, docs, ids, crc, tmp_path):
    rows = [(30 - i, t) for i, t in enumerate(TEXTS)] + [(7, "again"), (7, "again")]
    path = str(tmp_path / "tokens")
    token_store.write(docs(*rows).repartition(3), path, tokenizer())
    got = [tuple(r) for r in token_store.digests(spark, path).orderBy("start").collect()]
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        mine = [*ids(text), 2]
        want.append((doc_id, start, len(mine), crc(mine)))
        start += len(mine)
    assert got == want
    found = token_store.lookup(spark, path, 30 - 4).collect()
    assert [r["ids"] for r in found] == [[*ids(TEXTS[4]), 2]]
    plan = token_store.lookup(spark, path, 26)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,26)]" in plan or "EqualTo(doc_id,26)" in plan


def test_store_of_nothing(spark, docs, tmp_path):
    token_store.write(docs(), str(tmp_path / "none"), tokenizer())
    assert token_store.digests(spark, str(tmp_path / "none")).count() == 0


def test_packing(docs, ids, crc):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (50, "twice"), (50, "twice")] + [(100 + i, "w " * (i * 7 % 300)) for i in range(120)]
    got = [r.asDict() for r in packing.pack(docs(*rows), tokenizer(), length=64).collect()]
    texts = dict(rows)
    pieces: dict = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, mine in pieces.items():
        if doc_id == 50:
            assert len(mine) == 2
            continue
        mine.sort(key=lambda r: r["piece"])
        all_ids = [*ids(texts[doc_id]), 2]
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(all_ids)
        assert all(r["length"] == 64 for r in mine[1:]) and 1 <= mine[0]["length"] <= 64
        at = 0
        for r in mine:
            assert r["start"] == at and r["ids_crc32"] == crc(all_ids[at:at + r["length"]])
            at += r["length"]
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 64) + 2
    assert packing.pack(docs(), tokenizer()).count() == 0


def exact_bins(sizes, length):
    """The least number of sequences, by trying all ways."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*rooms, length - sizes[i]])

    place(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_loses_nothing(sizes):
    counts: dict = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    fixed, rest = packing.reduced(counts, 20)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sorted([s for p, n in fixed for s in p * n] + left) == sorted(sizes)
    assert sum(n for _, n in fixed) + (exact_bins(left, 20) if left else 0) == exact_bins(sizes, 20)
    whole = packing.plan(counts, 20)
    assert sorted(s for p, n in whole for s in p * n) == sorted(sizes) and all(sum(p) <= 20 for p, _ in whole)


def test_best_fit_is_that_of_single_items():
    counts = {9: 3, 7: 5, 4: 6, 3: 7, 2: 4}
    rooms: list = []
    for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 20) - s)
    assert sum(n for _, n in packing.best_fit(counts, 20)) == len(rooms)
