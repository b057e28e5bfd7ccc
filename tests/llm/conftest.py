import pytest

WORDS = "the of and to in that it with thion ere stand Over BLOCK émo ça naïve x1 y-2 don't ünd 漢字".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    columns whose names clash with those used inside the operators."""
    import random
    rng = random.Random(5)
    base = [sentence(rng, 80) for _ in range(6)]
    shared = "This line stands in many documents and is long enough."
    rows = []
    for i in range(60):
        t = base[i % 6] if i % 5 == 0 else sentence(rng, rng.randint(1, 150))
        if i % 4 == 0:
            t += "\n  " + (shared if i % 8 else shared.upper()) + "\t\n" + sentence(rng, 12)
        if i % 7 == 0:
            t = t + "\n" + t
        rows.append((i, t, "en", f"s{i % 3}", len(t)))
    rows += [(100, "", "en", "s0", 0), (101, None, None, None, None), (102, " \t\n \r\n", "de", "s1", 6),
             (103, "One", "en", "s1", 3), (104, "one two", "en", "s1", 7), (105, "漢" * 300, "zh", "s2", 300),
             (106, sentence(rng, 30_000), "en", "s2", 1), (107, "\n".join([shared] * 400), "en", "s0", 1),
             (108, "a " * 5_000, "en", "s0", 1), (109, "é" * 50 + "\x1c\x85 z", "en", "s1", 3)]
    rows += [rows[3], rows[3], rows[10]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema).repartition(3)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(c) for c in ("row", "key", "pos", "doc", "drops", "line", "fp", "u", "v", "steps",
                                                 "times", "w_source", "n", "root", "low")}).cache()


@pytest.fixture(scope="session")
def odd_rows(odd_docs):
    return [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
