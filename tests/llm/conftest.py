import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice(["ab", "cd", "Ef", "ghi", "É", "j.", "kl,", "mno"]) + str(rng.randrange(40)) for _ in range(n))


def edge_rows():
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(7)
    long_text = "\n".join(sentence(rng, 30) for _ in range(300))
    base = sentence(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = sentence(rng, 45)
    lines = [sentence(rng, 6) for _ in range(8)]
    texts = [
        base, base, near, near + " tail", long_text, "", None, " \t\n ", "one", "one two three four",
        passage + " x1 " + sentence(rng, 50), sentence(rng, 41) + "\n" + passage, passage + "\t" + passage,
        "\n".join(lines), "intro\n" + "\n".join(lines[2:7]) + "\nend", "\n".join([lines[0]] * 9),
        "a " * 200, "### $$$ %%% " * 30, "x" * 5000, "one two three four", "\x1c\x1f\x85\xa0 ​ \x00 é é ﬁ <|endoftext|>",
        "</s>[INST] \\ ok [/INST]", "one\ntwo\none\n\nthree",
    ]
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, 0) for i, t in enumerate(texts)]
    rows += [rows[0], rows[6], rows[8], (None, base, None, None, None), (None, None, None, "src1", None), (3, "other text of a known id", "en", "src0", 1)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """The rows with columns named like what the operators make."""
    names = "n_words ids decoded kept text_hash chunk bucket label node cls band sig h v m starts _at2 n_tokens rank".split()
    return edge.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
