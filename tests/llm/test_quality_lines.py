import re
from collections import Counter

from gridloom.llm.quality_lines import base_counts, clean, judge, normal_line

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_counts(documents):
    texts = [r.text for r in documents.collect()] + ["", " \n\t", "a b c a b c", "a a a a", "a a a", "é#\n é#\n\né#", "x" * 10_000, "la la " * 3000, "\x1c \x85 b"]
    for t in texts:
        assert base_counts(t.encode(), t.encode().split()) == brute_counts(t)


def body(k, n=60):
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{k}x{i}".translate(letters) for i in range(n))


def brute_judge(rows, min_docs, max_share, least_left):
    """Rows (id, text, host) -> kept and words removed, by plain loops."""
    who, all_of = {}, {}
    for i, t, h in rows:
        one = t or ""
        all_of.setdefault(h or "", set()).add(one)
        for line in (t or "").encode().split(b"\n"):
            if normal_line(line):
                who.setdefault((h or "", normal_line(line)), set()).add(one)
    out = []
    for i, t, h in rows:
        n, _, _, _, rep = brute_counts(t or "")
        gone = 0
        for line in (t or "").encode().split(b"\n"):
            d = len(who.get((h or "", normal_line(line)), ()))
            if d > min_docs and d > max_share * len(all_of[h or ""]):
                gone += len(line.split())
        failed = n < 50 or 100 * rep > 50 * n
        out.append((i, failed, not failed and n - gone >= least_left * n, gone))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, t, h, "x", 1) for i, t, h in rows], "doc_id long, text string, source string, host string, n_words int")


def test_boilerplate(spark):
    notice = "Subscribe to our Letter No 7 " + " ".join(f"now{i}" for i in range(40))
    rows = [(k, f"{body(k)}\n{notice.upper() if k % 2 else notice.replace('7', '9')}\nlast {body(k, 2)}", "a") for k in range(12)]
    rows += [(100 + k, f"short {k}\n{notice}\n{notice}", "a") for k in range(3)]  # depleted
    rows += [(200, f"{body(200)}\n{notice}", "b"), (201, body(201), None), (202, None, None), (None, body(203), ""), (204, "", "a")]
    rows += [(300 + k, body(5) + "\nthe same text every time", "c") for k in range(30)]  # copies are one document
    rows += [(7, rows[7][1], "a")]
    limits = dict(min_docs=5, max_share=0.1, least_left=0.4)
    df = table(spark, rows)
    got = judge(df, **limits)
    assert sorted(((r.doc_id, r.base_failed, r.kept, r.words_removed) for r in got.collect()), key=repr) == brute_judge(rows, 5, 0.1, 0.4)
    out = {(r.doc_id, r.source): r for r in clean(df, **limits).collect()}
    assert out[3, "a"].text == f"{body(3)}\nlast {body(3, 2)}" and (100, "a") not in out and out[200, "b"].text.endswith(notice) and (300, "c") in out
    assert clean(df, **limits).columns == df.columns
    assert sum(r.doc_id == 7 for r in clean(df, **limits).collect()) == 2


def test_clashing_columns(spark):
    """Columns that have the names used inside pass through; repeated rows stay repeated."""
    notice = " ".join(f"now{i}" for i in range(12))
    extra = ["_kept", "_id", "_host", "_digest", "_lines", "kept", "digest", "lines_removed", "row", "id", "a.b"]
    rows = [(k, f"{body(k)}\n{notice}", "a", *[f"{c}{k}" for c in extra]) for k in range(9)]
    rows += [rows[3], (None, body(20), None, *extra), (21, None, "a", *extra), (22, "", "a", *extra), (23, "short", "a", *extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in extra))
    got = clean(df, min_docs=5, max_share=0.1)
    assert got.columns == df.columns
    want = [(r[0], r[1].removesuffix("\n" + notice), *r[2:]) for r in rows[:11]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    df = table(spark, [])
    assert judge(df).collect() == [] and clean(df).collect() == []
