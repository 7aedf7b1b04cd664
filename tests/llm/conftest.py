from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """Tables of awkward rows: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    import random

    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "ka le mi no pu ra se ti vo zu".split() for b in "ban del fir gos hum".split()]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = prose(120)
    w = base.split()
    near = " ".join([*w[:60], "changed", *w[61:]])
    far = " ".join([*w[:80], *prose(80).split()])
    long = prose(9000)
    passage = prose(70)
    texts = [base, base, near, far, None, "", "   \n\t ", "one", "one", "two words", long, long + " tail", base.upper(), passage]
    texts += [f"{prose(60)} {passage} {prose(60)}" for _ in range(4)] + ["same line\nsame line\nother line", "é ñ ü " * 12]
    texts += [f"{' '.join(w[:k])} {prose(2)} {' '.join(w[k + 2:])}" for k in range(5, 115, 6)]
    texts += [prose(rng.randint(1, 30)) for _ in range(60)]
    rows = [(k, t, ("en", "de", None)[k % 3], (None, "a", "b", "Z")[k % 4], len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, "text without an id", "en", "a", 18), (None, None, None, None, None)]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.createDataFrame(small, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def crowded_docs(small_docs):
    """The same with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = "key a b n hash size place bucket component rep doc words target copies taken score segments label_id wanted".split()
    return small_docs.select("*", *[F.lit(1).alias(n) for n in names])
