"""Small corpora for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row long, n int, t string, size long, digest string, kept boolean"
WORDS = {"en": "the of and that with from reading water house under silver morning", "fr": "le la des avec pour maison é où être sous rivière matin", "de": "der die und nicht für schön über haus fluß morgen silber unter"}


def prose(rng, lang, n):
    words = WORDS[lang].split()
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "en", "x" + str(rng.randint(0, 99))]) for _ in range(n))


def rows(seed=0, n=60):
    """Documents with copies, near copies, a shared passage, nulls, empties, blanks, a long text and repeated rows."""
    rng = random.Random(seed)
    out = []
    passage = prose(rng, "en", 90)
    for i in range(n):
        lang = rng.choice(list(WORDS))
        text = prose(rng, lang, rng.choice([1, 2, 3, 8, 40, 120]))
        if i % 9 == 3:
            text = text + "\n" + passage + "\n" + prose(rng, lang, 10)
        if i % 10 == 4 and out:
            text = out[rng.randrange(len(out))][1]
        if i % 10 == 7 and out:
            text = (out[rng.randrange(len(out))][1] or "").upper()
        if i % 10 == 9 and out:
            words = (out[rng.randrange(len(out))][1] or "").split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        out.append((i, text, lang if i % 11 else None, ["a", "b", "é", None][min(3, rng.randrange(8))]))
    out += [(n, None, None, "a"), (n + 1, "", "en", None), (n + 2, " \t\n", "fr", "b"), (n + 3, "12 34 - 56 !", None, "b"), (n + 4, "don't 'Tis É日本 <|endoftext|> ΑΣ ok", "en", "a")]
    out += [(n + 5, prose(rng, "de", 3000), "de", "b"), (None, prose(rng, "en", 30), "en", "a"), (None, None, None, None)]
    out += [out[3], out[3], out[12]]  # repeated rows
    return out


def frame(spark, data, parts=3):
    full = [(i, t, lang, s, 7, 5, 1, 2, "x", 9, "y", False) for i, t, lang, s in data]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)


def parquet(spark, data, path):
    """A folder with documents.parquet, for the registered queries."""
    frame(spark, data).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def words(text):
    return (text or "").encode().lower().split()
