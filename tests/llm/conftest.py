import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "ren", "Éau", "thin#", "a", "and|or", "être", "zz", "tion"]) + rng.choice(["", "x", "er", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, exact copies, near copies and shared passages."""
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "a", prose(rng, 6000), "x" * 5000, "one two\nthree\n\none two\n", "日本語 テキスト 😀 ok"]
    texts += [prose(rng, rng.randint(1, 300)) for _ in range(60)]
    shared = prose(rng, 80)
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, 30) for _ in range(6)]
    texts += [texts[20]] * 7 + [t + " end" for t in texts[20:28]]
    texts += [texts[20].replace("the", "then", k) for k in range(1, 8)]
    texts += [" ".join(["again and again"] * 40)] * 2
    out = [(i, t, "en", None if i % 11 == 5 else f"src{i % 4 if i % 3 else 0}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(docs):
    """The documents with extra columns whose names clash with ones used inside, and each row twice."""
    from pyspark.sql import functions as F

    wide = docs.select("*", *[F.lit(7).alias(n) for n in ("_w", "_text", "n", "h", "key", "_host", "size", "n_words", "component_id", "fingerprint", "piece", "shard", "_n")])
    return wide.union(wide)


@pytest.fixture(scope="session")
def sf_dir(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path
