import math
import re
from collections import Counter, defaultdict

from tallyboard.llm import quality_rules as q

PROSE = "The of and to in a is that for it was on with as be at by this from are or an not his but have which had were they. " * 8
ROWS = [(1, PROSE, "en"), (2, PROSE.upper(), "en"), (3, " ".join(f"{w}%%%" for w in PROSE.split()), "en"), (4, None, "en"), (5, "", None), (6, "one two\none two\n\n \n", "xx"),
        (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en"), (8, "same " * 30, None), (9, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(12))), "de"),
        (10, "x\t#*$%&|<>\x0by\r\n" * 20, "fr"), (11, PROSE + "\n" + PROSE, "en"), (12, " ".join(f"w{i}" for i in range(3000)), "es"), (None, PROSE, "en")]


def counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_counts_and_base(docs):
    got = {r["doc_id"]: r for r in q.judge(docs(*ROWS)).collect()}
    for doc_id, text, _ in ROWS:
        n, chars, symbols, dup, repeat = counts(text)
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat), doc_id
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert not (r["base_failed"] and r["kept"])


def distance(p, q):
    h = lambda v: -sum(x * math.log2(x) for x in v if x > 0)
    return math.sqrt(max(0.0, h([(a + b) / 2 for a, b in zip(p, q)]) - (h(p) + h(q)) / 2))


def test_word_distance(docs):
    """Against the definition, over all listed words and the rest."""
    rows = [(1, PROSE, "en"), (2, "the " * 60 + "zebra " * 60, "en"), (3, "zebra " * 90, "en"), (4, "le la les " * 30, "en")]
    got = {r["doc_id"]: r["word_distance"] for r in q.judge(docs(*rows)).collect()}
    known = {w for listed in q.COMMON_WORDS.values() for w in listed.split()}
    said = {i: [w for w in re.split(r"[^a-z]+", t.lower()) if w] for i, t, _ in rows}
    total = Counter(w for ws in said.values() for w in ws)
    n = sum(total.values())
    names = sorted(known & set(total))
    share = lambda c, m: [c[w] / m for w in names] + [1 - sum(c[w] for w in names) / m]
    for i, ws in said.items():
        assert abs(got[i] - distance(share(Counter(ws), len(ws)), share(total, n))) < 1e-6


def test_unusual_text_fails_and_short_text_passes(docs):
    usual = [(100 + i, " ".join(PROSE.split()[i:i + 100]) + f" {i} zebra{i} tree{i}.", "en") for i in range(100)]
    odd = " ".join(f"w{i}%%%" for i in range(100))
    rows = [*usual, (1, odd, "en"), (2, " ".join(f"A{i}&b|" for i in range(25)), "en"), (3, "Plain words of no great length that any one may write in a note to a friend who is away for now.", "en")]
    got = {r["doc_id"]: r for r in q.judge(docs(*rows), limits=q.Limits(max_repeat_percent=100)).collect()}
    assert not got[1]["kept"] and not got[1]["base_failed"] and got[1]["char_distance"] > 0.28
    assert got[2]["char_distance"] is None and got[3]["kept"] and got[3]["word_distance"] is None
    assert all(got[i]["kept"] for i, _, _ in usual)


def test_nothing(docs):
    assert q.judge(docs()).count() == 0
