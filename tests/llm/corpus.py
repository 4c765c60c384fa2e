"""A small invented corpus with copies, shared passages, nulls and columns of clashing names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that the operators use themselves
    "n long, doc long, tag long, line long, trigger long, phrase long, queue string, task int, "
    "kept boolean, spans string, set1 long, node long, rate double, h1 long, words string, block string, "
    "host string, quality string, z binary, ids binary"
)
EXTRA = SCHEMA.count(",") + 1 - 5


def vocabulary(seed: int = 7, size: int = 3000) -> list[str]:
    draw = random.Random(seed)
    parts = ["ka", "lo", "mi", "ru", "té", "sö", "qu", "Za", "ne", "ba"]
    return ["".join(draw.choices(parts, k=draw.randint(1, 5))) for _ in range(size)]


def sentence(draw: random.Random, words: list[str], n: int) -> str:
    return " ".join(draw.choices(words, k=n))


def texts(seed: int = 1) -> list[str | None]:
    draw, words = random.Random(seed), vocabulary()
    passage = sentence(draw, words, 70)
    line = sentence(draw, words, 14)
    out: list[str | None] = [None, "", " \t\n\r ", "one", "one two", "x" * 900, "ab " * 400]
    for i in range(60):
        lines = [sentence(draw, words, draw.randint(1, 40)) for _ in range(draw.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(draw.randint(0, len(lines)), passage)
        if i % 3 == 0:
            lines.append(line)
        if i % 5 == 0:  # a word of the line replaced, or one more
            changed = line.split()
            changed[draw.randint(0, 13)] = draw.choice(words)
            lines.append(" ".join(changed))
            changed.insert(draw.randint(0, 13), draw.choice(words))
            lines.append(" ".join(changed))
        out.append("\n".join(lines))
    whole = out[-1] + "\n" + sentence(draw, words, 300)
    out.append(whole)
    for _ in range(30):  # near copies of one text that need not be near each other
        changed = whole.split(" ")
        for _ in range(6):
            changed[draw.randint(0, len(changed) - 1)] = draw.choice(words)
        out.append(" ".join(changed))
    out += [whole, whole, out[8], sentence(draw, words, 12_000)]
    return out


def rows(seed: int = 1) -> list[tuple]:
    """One row per text, ids falling, some without source; then two that agree, and one without id."""
    every = texts(seed)
    made = [
        (1000 - i, t, "en", None if i % 9 == 0 else f"s{i % 4 if i % 3 else 0}", None) for i, t in enumerate(every)
    ]
    made += [made[20], (None, every[12], None, "s1", 5), (None, None, None, None, None)]
    return [(*r, *[None] * EXTRA) for r in made]


def frame(spark, made: list[tuple] | None = None):
    return spark.createDataFrame(rows() if made is None else made, SCHEMA).repartition(3)


def small(spark, *made):
    """Rows of (doc_id, text) alone."""
    return spark.createDataFrame(list(made), "doc_id long, text string")
