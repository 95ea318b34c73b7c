import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _key string, kept string"


def make_docs(seed: int = 3, n: int = 60) -> list[tuple[int, str]]:
    """Texts of random words with copies, near copies, shared passages, ties and oddities."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = text(30)
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not out:
            t = text(rng.randint(1, 120))
        elif kind == 1:
            t = rng.choice(out)[1]  # a copy
        elif kind == 2:
            words = rng.choice(out)[1].split() or ["x"]
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        elif kind == 3:
            t = text(20) + "\n" + passage + "\n" + text(20)
        elif kind == 4:
            t = text(15) + "\n" + "Called at 12:%02d by host-%d from the old gate of the town hall\n" % (i, i) + text(5)
        else:
            t = "naïve Ünïcode ▁ 😀 " + text(40)
        out.append((i * 3, t))
    return out


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) rows with nulls, empty and long texts, and repeated rows."""
    rows = make_docs()
    rng = random.Random(9)
    longest = "\n".join(" ".join(rng.choice("red green blue white black".split()) for _ in range(40)) for _ in range(300))
    rows += [(1000, ""), (1001, None), (1002, " \n\t "), (1003, longest), (1004, longest + " end"), rows[7], (1005, "one"), (1006, "one"), (1007, "a" * 4000)]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 0.5, "k", "no") for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def docs(frame, pairs):
    return frame(pairs).repartition(5)


@pytest.fixture(scope="session")
def more_docs():
    return make_docs(seed=21, n=90)
