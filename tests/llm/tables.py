"""Small tables with every odd row the operators have to take: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, n_words int, label int, cls long, token long"
KEY = "MIIEpAIBAAKCAQEA"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    made = random.Random(seed)
    names = ["".join(random.Random(i).choices("abdeghiklmnorstu", k=3 + i % 6)) for i in range(vocabulary)]
    return " ".join(made.choice(names).capitalize() if i % 9 == 0 else made.choice(names) + "," * (i % 7 == 0) for i in range(words)) + "."


def rows(texts: list[str | None], first: int = 0) -> list[tuple]:
    return [
        (first + i, t, "en", f"src{i % 3}" if i % 5 else None, None if t is None else len(t), 0.5, "x", 3, 1, 7, None) for i, t in enumerate(texts)
    ]


def changed(text: str, places: list[int]) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = f"other{p}"
    return " ".join(words)


def odd_texts() -> list[str | None]:
    base = prose(1, 120)
    return [
        None, "", " \n\t ", "one", "two words", base, base, changed(base, [60]), changed(base, [3, 30, 90]), prose(2, 200), prose(3, 20_000),
        "Ünder ÉTÉ straße 中文。 é́ \x00 \x1f İ K", base + " tail", prose(2, 200).upper(), "a b c", "A  b\nC", None, prose(4, 60),
    ]


def documents(spark, texts: list[str | None] | None = None):
    made = rows(odd_texts() if texts is None else texts)
    if texts is None:
        made += [made[5], (None, "no id here", None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(made, SCHEMA)
