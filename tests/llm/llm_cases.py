"""Documents with every awkward case, and names that clash with the operators' own columns."""

import random

SCHEMA = (
    "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, kept BOOLEAN, node LONG, ids STRING, lang_pred STRING, "
    "_spans STRING, host STRING, row STRING, n INT, unit STRING, part INT"
)


def words(rng, n, alphabet="the of and nation erth whing onder lith".split()):
    return " ".join(rng.choice(alphabet) + rng.choice(["", "s", "er", "ing", ",", "."]) for _ in range(n))


def documents():
    rng = random.Random(7)
    texts = [words(rng, rng.randint(1, 200)) for _ in range(60)]
    german = "der die das und ist nicht ein eine mit auf für schön größer".split()
    texts += [words(rng, rng.randint(20, 200), german) for _ in range(40)]
    base = words(rng, 120).split()
    for i in range(30):  # near copies: one word changed
        t = list(base)
        t[rng.randrange(len(t))] = f"changed{i}"
        texts.append(" ".join(t))
    texts += [texts[3]] * 5  # exact copies
    texts += ["", None, "   \n\t ", "one", "One TWO three", "one two three", "12345 67890", "!!! ???", "x" * 5000, "a b " * 2000, "\x00a", "é\x00", "é"]
    texts += [words(rng, 3000), "word " * 400, "mail me at jane.doe@mail.example.com or +1 (212) 555-0199 4111111111111111 now"]
    texts += ["<|endoftext|> and <|STARTOFTEXT|> <|im_end|>", "tab\tand\x0bline\nline\nline\n", "日本語 テキスト ▁ 😀"]
    rows = []
    for i, t in enumerate(texts):
        lang = "de" if 60 <= i < 100 else ("en" if i < 140 else None)
        rows.append((i, t, lang, None if i % 11 == 0 else f"src{i % 5}", None if t is None else len(t), True, 5, "x", "zz", "s", "h", "r", 1, "u", 2))
    rows.append(rows[10])  # a repeated row
    rows.append((None, "no key here at all, and yet some words to read in it", "en", "src1", 10, None, None, None, None, None, None, None, None, None, None))
    rows.append((20, texts[50], "en", "src1", 10, None, None, None, None, None, None, None, None, None, None))  # one id, another text
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
