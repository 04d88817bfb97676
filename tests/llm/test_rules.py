import re
from collections import Counter

from trackmart.llm import rules

from .cases import PROSE, documents, empty, rows_of

EXTRA = [
    "UPPER!! CASE!! WORDS!! " * 20,
    " ".join(f"{w}###" for w in PROSE.split()) * 3,
    " ".join(f"word{i} {i} of" for i in range(60)) + " " + PROSE + PROSE,
    "alpha beta gamma delta epsilon zeta eta theta iota " * 2,
]


def brute_force(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    symbols = sum(c in rules.SYMBOLS for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def test_base_counts_equal_brute_force(spark):
    from .cases import TEXTS

    docs = documents(spark, TEXTS + EXTRA)
    got = rules.apply_rules(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in got) == Counter((i, *brute_force(t)) for i, t in rows_of(docs))
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_verdicts(spark):
    clean = " ".join(f"{w}{i % 9}" if len(w) > 4 else w for i, w in enumerate((PROSE * 3).split()))
    docs = documents(spark, [clean, *EXTRA[:2], "Oneaea " * 6 + " ".join(f"{w} {w} {w}" for w in PROSE.split())])
    kept = {r["doc_id"]: r["kept"] for r in rules.apply_rules(docs).filter("doc_id IS NOT NULL").collect()}
    assert kept == {0: True, 3: False, 6: False, 9: False}
    assert rules.apply_rules(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = rules.apply_rules(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
