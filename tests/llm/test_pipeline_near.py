"""The near-duplicate stage of the pipeline against brute force."""

import random

import corpus_pipeline


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    rng, texts = random.Random(8), []
    words = lambda n: [f"w{rng.randrange(1 << 40)}" for _ in range(n)]
    for more in range(10, 34):
        base = words(100)
        texts += [base, base + words(more)]  # 96 of 96 + more shingles
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect())
    assert kept == sorted(set(label)) and len(kept) == 33
