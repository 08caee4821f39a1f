import random
from collections import Counter

import corpus_pipeline

from gridloom.llm.quality_lines import judge


def test_lines_of_a_large_host(spark):
    """Lines above and below 1 % of a host whose documents draw on few words, so that many share their extreme words' hashes."""
    rng = random.Random(6)
    words = [a + b for a in "bcdfghklmn" for b in "aeiouxyz"]
    notices = {"often": 33, "seldom": 29}
    rows = []
    for k in range(3000):
        lines = [" ".join(rng.choices(words, k=60)), " ".join(rng.choices(words, k=60))]
        lines += [f"the notice that stands {name}" for name, n in notices.items() if k % 90 == len(name) and k // 90 < n]
        rows.append((k, "\n".join(lines), "a"))
    assert Counter(x for _, t, _ in rows for x in t.split("\n")).most_common(2) == [("the notice that stands often", 33), ("the notice that stands seldom", 29)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = " ".join(r.text for r in corpus_pipeline.quality(spark, df, "").collect())
    assert left.count("stands often") == 0 and left.count("stands seldom") == 29
    assert judge(df).filter("words_removed > 0").count() == 33
