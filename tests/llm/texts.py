"""Small documents with copies, near copies, shared passages, nulls and odd characters."""

import random


def documents(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé日", k=rng.randint(1, 6))) for _ in range(300)]
    words = lambda k: rng.choices(vocabulary, k=k)
    passage, other = words(80), words(60)
    out = []
    for k in range(n):
        kind = k % 10
        if kind < 3 or not out:
            text = " ".join(words(rng.randint(1, 200)))
        elif kind == 3:
            text = " ".join([*words(20), *passage, *words(30)])
        elif kind == 4:
            text = rng.choice(out)
        elif kind == 5:
            w = (rng.choice(out) or "a b").split()
            w[rng.randrange(len(w))] = "zzz"
            text = " ".join(w)
        elif kind == 6:
            text = " ".join([*other, *words(10), *other[: rng.randint(40, 60)]])
        elif kind == 7:
            text = "\n".join(["Page 12 of 30", *[" ".join(words(9)) for _ in range(4)], "All Rights Reserved"])
        elif kind == 8:
            text = "ab" * rng.randint(10, 200) + "\t" + " ".join(words(60)) + "\r\n"
        else:
            text = " ".join(words(rng.randint(1, 4)))
        out.append(text)
    out[7], out[19], out[29] = None, "", " \n\t "
    return list(enumerate(out))


def frame(spark, docs):
    """With columns that the operators must not stumble over."""
    rows = [(i, t, "en", "src", None if t is None else len(t), "x", "y", 1) for i, t in docs]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string, run string, mask int")


def columns(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
