"""Small tables with what operators have to bear: nulls, empty and long texts, repeated rows, clashing columns."""

import random

WORDS = "the of and to a in that is was he for it with as his on be at by i this had not are but from".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "s"]) for _ in range(words))


def awkward_texts(seed=1):
    """Texts with copies, near copies, shared passages and lines, odd spaces and characters, and a very long one."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(25)]
    passage, line = prose(rng, 40), "All rights  reserved."
    texts = [*base, *base[:6], *(b.upper() for b in base[6:9])]
    texts += [f"{prose(rng, 15)} {passage} {prose(rng, 9)}" for _ in range(6)]
    texts += [f"{prose(rng, 8)}\n {line.swapcase() if i % 2 else line}\t\n{prose(rng, 5)}" for i in range(12)]
    texts += [b + " more" for b in base[9:14]]
    texts += [None, None, "", " ", "\n", "\n\n a\n", "é" * 60, "aé" * 40 + "\n" + "aé" * 30, "12 345 !?", "x" * 49, "y" * 50,
              "日本語 テキスト", "tab\tand\x0bmore  spaces ", "a <|endoftext|> b<|endoftext|>", "it's  don't\x1c ok", prose(rng, 3000)]
    return texts


def documents(spark, texts, first_id=0):
    """Rows with every other column a documents table has, and some whose names clash with what operators add."""
    rows = [(first_id + i, t, ["en", "fr", None][i % 3], f"src{i % 4}", len(t or ""), "clash", i, True) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, n_tokens int, kept boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


def empty(spark):
    return documents(spark, ["x"]).where("doc_id < 0")


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}
