"""Small frames with every awkward case: nulls in any column, empty and very long
texts, ties, repeated rows, and extra columns whose names clash with results."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, shard int, slot long, "
          "fp string, component_id string, label string, norm string, salt string, size string, budget long, tokens long, h string, epoch string")


def texts() -> list:
    rnd = random.Random(5)
    words = [w + x for w in ("the", "and", "Straße", "été", "niño", "of", "thing", "with") for x in ("", "s", "ed", "ly.")]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = prose(60)
    near = base.replace(" ", "  ", 3)
    return [base, base, base.upper(), near, None, None, "", " ", "\n\t", "a", "A", "É", "é", "12345 !!", prose(40_000), "x" * 300_000, prose(9),
            "<|endoftext|> <|im_start|>", "tail  spaces  \n x ", " nbsp   wide", "日本語 テキスト です", "😀 emoji 👩‍👩‍👧", prose(200), prose(200)]


def documents(spark):
    rows = []
    for i, t in enumerate(texts()):
        doc_id = None if i in (3, 6) else 7 if i in (16, 17) else i
        rows.append((doc_id, t, None if i % 5 == 0 else "en" if i % 2 else "de", None if i % 7 == 0 else f"src{i % 4}", None, None, None, 99, 5, "x",
                     "y", None, "z", "s", "t", 1, 2, "h", "e"))
    rows += [rows[0], rows[4], rows[8]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
