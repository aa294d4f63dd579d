import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from llm_helpers import brute, changed
from tallyboard.llm import mixing, near_dedup, queries

EN = "the cat and dog went to other town with them when it was late in year for this that from have been".split()
DE = "der Hund und die Katze gehen nicht über schöne Straßen weil es noch sehr kalt ist wenn wir nach Hause kommen".split()
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, the table of documents first."""
    rng = random.Random(8)
    rows = []
    for i in range(90):
        words = [rng.choice(EN if i % 3 else DE) + rng.choice(["", "", "en", "s"]) + str(rng.choice(["", "", rng.randint(0, 99)])) for _ in range(rng.randint(40, 160))]
        rows.append([i, " ".join(words), "en" if i % 3 else "de", f"s{i % 4 if i % 5 else 0}"])
    rows += [[100, rows[3][1], "de", "s1"], [101, rows[3][1].replace(" ", " \n", 5), None, "s2"], [102, rows[7][1] + " end", "en", None], [103, None, "en", "s1"], [104, "12 34 !!", "en", "s1"],
             [105, "", None, "s1"], [None, rows[8][1], "en", "s1"], [106, " ".join(EN * 300), "en", "s3"], [100, rows[3][1], "de", "s1"]]
    path = str(tmp_path_factory.mktemp("corpus"))
    data = [(*r, len(r[1] or "")) for r in rows]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append([tuple(r) for r in docs.select(*[c for c in COLUMNS if c in docs.columns]).collect()])
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        assert name == "packing" or docs.columns == COLUMNS
    return [*out, [r.asDict() for r in docs.collect()]], path


def test_language_keeps_clean_documents(stages):
    raw, kept = stages[0][:2]
    gone = [r for r in raw if r not in kept]
    assert sorted(r[0] for r in gone) == [103, 104, 105] and len(kept) == len(raw) - 3


def test_without_labels_clean_documents_stay(spark, docs):
    rows = [(1, "some clean text"), (2, "ein anderer Text"), (3, "12 34 !!"), (4, None), (5, "")]
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs(*rows), "").collect()) == [1, 2]
    bare = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, bare, "").collect()) == [1, 2]


@pytest.mark.parametrize("rows", [[], [(1, "one text of two blocks, eight words each, so that the mix can take it whole. " "Fine.", "en", "s")], [(1, None, None, None)]])
def test_small_corpora(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [r[0] for r in rows if r[1]]


def test_exact_copies(stages):
    before, after = stages[0][1:3]
    first: dict = {}
    for r in before:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1])
        first[key] = min(first.get(key, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted(r[0] for r in after) == sorted(i for null, i in first.values() if not null)
    assert len(after) == len(first) and Counter(after) <= Counter(before)


def test_near_copies(stages):
    before, after = stages[0][2:4]
    weights = near_dedup.Weights({"runs": near_dedup.np.empty(0, near_dedup.np.uint64), "uses": near_dedup.np.empty(0, near_dedup.np.int64)}, 1)
    assert 102 not in {r[0] for r in after} and Counter(after) <= Counter(before)
    for i, a in enumerate(after):
        for b in after[:i]:
            assert near_dedup.similarity(a[1].encode(), b[1].encode(), weights) < 0.95


def test_near_copies_as_by_all_pairs(docs, spark):
    """The stage keeps one document of each class that comparing all pairs at its threshold gives: chains, a cloud, near copies."""
    rng = random.Random(21)
    new = lambda n: [f"u{rng.random()}" for _ in range(n)]
    rows, passage = [], new(60)
    for _ in range(20):
        a = new(200)
        b = a + new(14)
        rows += [" ".join(a), " ".join(b), " ".join(new(42) + b)]
    rows += [" ".join(passage + new(rng.randint(6, 14))) for _ in range(40)]
    rows += [changed(rng, passage + rows[-1].split()[60:] + new(100), k) for k in (0, 1, 2)]
    rows = list(enumerate(rows))
    after = corpus_pipeline.drop_near_copies(spark, docs(*rows), "").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in after) == sorted(rows[i] for i in {c for _, c in brute(rows)})


def test_mix_follows_its_targets(spark, stages):
    before, after = stages[0][3:5]
    words = lambda rows: Counter({s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in {r[3] for r in rows}})
    frame = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    targets = {r["source"]: r["target"] for r in mixing.mix(frame, carry=True).select("row.source", "target").distinct().collect()}
    got = words(after)
    assert all(abs(got[s] - t) <= mixing.BLOCK_WORDS for s, t in targets.items())
    texts = {r[0]: r[1] for r in before}
    assert all(" ".join(texts[r[0]].split()).startswith(" ".join(r[1].split())) and r[4] == len(r[1]) for r in after)


def test_packing_holds_all(stages, crc):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer())
    docs, pieces = stages[0][4], stages[0][5]
    want = Counter()
    for r in docs:
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 2]
        first = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want.update((r[0], i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == want
    rooms = Counter()
    for p in pieces:
        rooms[p["sequence_id"]] += p["length"]
    assert max(rooms.values()) <= 1024 and len(rooms) <= -(-sum(rooms.values()) // 1024) + 1


def test_run_is_the_stages(spark, stages):
    path = stages[1]
    got = corpus_pipeline.run(spark, path)
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in got.collect()} == {(p["doc_id"], p["piece"], p["ids_crc32"]) for p in stages[0][5]}


def test_contracts(spark):
    """Columns and types of the queries, on the smallest tables."""
    types = {"op1": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
             "op2": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
             "op3": "page_id bigint, host string, path string, rule string, verdict string",
             "op4": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
             "op5": "doc_id bigint, held_out boolean, lang_pred string, score double",
             "op6": "doc_id bigint, class_id bigint, class_size bigint, kept boolean",
             "op7": "page_id bigint, url string, text string, n_chars bigint",
             "op8": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
             "op9": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
             "op10": "doc_id bigint, held_out boolean, score double, predicted int",
             "op11": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
             "op12": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
             "op13": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"}
    data = "/root/testdata/sf0.001"
    for name, query in queries.QUERIES.items():
        df = query(spark, data)
        want = types[name.split("_")[0]].split(", ")
        assert [f"{n} {t}" for n, t in df.dtypes][:len(want)] == want, name
        table = "pages" if name.startswith(("op3", "op7")) else "documents"
        if not name.startswith(("op2", "op11")):
            assert df.count() == spark.read.parquet(f"{data}/{table}.parquet").count(), name
