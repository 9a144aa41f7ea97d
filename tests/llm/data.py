"""Small documents with every awkward case, and statements of the contracts in plain Python."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `n_words` long, `rid` string, `a b` string"


def documents(seed=1, size=60):
    rng = random.Random(seed)
    vocab = [
        "the", "of", "and", "é", "日本", "Zz9", "x",
        *("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(150))
    ]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    passage = say(60)
    texts = [
        None, "", "   \n\t ", "one", "two words", "Four words right here", "five words are in here", say(5000),
        "a" * 30000, passage, "word " * 400
    ]
    for i in range(size):
        if i % 4 == 0:
            texts.append(say(rng.randint(5, 250)))
        elif i % 4 == 1:
            words = rng.choice([t for t in texts if t and t.strip() and len(t) < 20000]).split()
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            texts.append(" ".join(words))
        elif i % 4 == 2:
            texts.append(f"{say(rng.randint(0, 40))} {passage} {say(rng.randint(0, 40))}")
        else:
            texts.append(rng.choice(texts))
    rng.shuffle(texts)
    rows = [
        (i * 3 - 7, t, "en", rng.choice(["src0", "src0", "src0", "s1", "é", "", None]), None, 1, "r", None) for i,
        t in enumerate(texts)
    ]
    return [*rows, rows[20], rows[21], (None, texts[12], None, None, None, None, None, None)]


def words(text):
    return (text or "").encode().split()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=repr)
