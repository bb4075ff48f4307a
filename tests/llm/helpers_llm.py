"""Small documents with every awkward case, and brute-force versions of the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, n_words string, kept int, shard string, slot string, label int, node string, sequence_id int, n_chars long"
VOCAB = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega the of and to in is for with from by École naïve straße").split()


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def corpus(seed=5):
    """(doc_id, text): near copies, exact copies, shared passages, nulls, empties, a long text, ties."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(30, 90)) for _ in range(6)]
    passage = sentence(rng, 30)
    out = []
    for b in base:
        words = b.split()
        for _ in range(4):
            w = list(words)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            out.append(" ".join(w))
        out.append(b + "\n" + passage)
    out += [base[0]] * 5 + ["", None, "one", "one", "Two words", "x", "\n \t", "éè", passage, passage + " " + base[2]]
    out.append(sentence(rng, 20_000))
    rng.shuffle(out)
    rows = list(enumerate(out, 1))
    rows += [rows[3], rows[3], (7, "same id, another text"), (None, base[1]), (None, None)]
    return rows


def frame(spark, rows, repartition=3):
    full = [(i, t, "en", "x", 7, "s", "l", 3, "n", 9, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(repartition)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def clusters(rows):
    """{row index: indices of its component}, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i] == rows[j] or (a and b and 100 * len(a & b) >= 75 * len(a | b)):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def repeats(rows, length=50):
    """Per row its bytes and which of them go."""
    low = {}
    raws = [(t or "").encode() for _, t in rows]
    key = lambda i: -(1 << 63) if i is None else i
    for (i, _), raw in zip(rows, raws):
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            low[w] = min(low.get(w, key(i)), key(i))
    out = []
    for (i, _), raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if low[raw[k:k + length]] < key(i):
                gone[k:k + length] = b"\1" * length
        out.append((raw, bytes(gone)))
    return out
