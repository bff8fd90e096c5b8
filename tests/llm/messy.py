"""Small tables with every awkward case: nulls, empty and long texts, repeats, extra columns with clashing names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, key long, node long, host string, rank int, text_hash long, salt int, label int, marks string"
)


def texts():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "é漢", "x'll", "THE", "the", "😀", "a\\b", "1,2"]
    passage = " ".join(rng.choice(words) + str(i) for i in range(60))
    long = " ".join(rng.choice(words) + str(rng.randrange(5000)) for _ in range(30_000))
    return [
        None,
        "",
        " \n\t ",
        "one",
        "two words",
        passage,
        f"before {passage} after",
        f"{passage}\nother line\n{passage}",
        long,
        long,
        "a a a a " * 40,
        "same line\nsame line\n\nlast",
        "same line\nmore",
        " no ascii\x1cspace",
    ]


def documents(spark):
    rows = []
    for i, text in enumerate(texts()):
        rows.append((i, text, None, None if i % 5 == 0 else f"s{i % 2}", None, "r", 1, 2, "h", 3, 4, 5, 6, "m"))
    rows += [rows[5], rows[3]]  # repeated rows
    rows += [(None, "no id", "en", "s1", 5) + rows[0][5:], (None, None, None, None, None) + (None,) * 9]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
