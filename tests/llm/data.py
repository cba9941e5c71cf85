"""Small tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _host string, node string, epoch int, v string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, and near copies."""
    rng = random.Random(3)
    base = prose(rng, 120)
    words = base.split()
    near = [" ".join(w if i not in at else "changed" for i, w in enumerate(words)) for at in ({5}, {5, 60}, {100}, {5, 60, 100})]
    long_text = prose(rng, 30_000)
    texts = [base, *near, base.upper(), base, prose(rng, 50), prose(rng, 50), "", None, " \n\t ", "word", "two words", "word",
             long_text, long_text + " end", "menu line\n" + prose(rng, 30), "menu line \nother\n" + prose(rng, 30),
             "mail me: a.b@example.com or +1 (212) 555-7777, 10.0.0.1!", "x" * 20_000, "é日本語 ñ <|endoftext|> don't 12"]
    out = [(i, t, "en", f"s{i % 3}", len(t or ""), "h", "n", 1, "v") for i, t in enumerate(texts)]
    out.append(out[7])                                                        # a repeated row
    out.append((100, None, None, None, None, None, None, None, None))
    out.append((None, base, None, None, None, None, None, None, None))        # no id, a copy
    out.append((None, "nobody else says this", None, "s1", 3, None, None, None, None))
    return out


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
