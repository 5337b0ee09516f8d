"""Spelling variants against brute force."""
import random
import re
import zlib
from collections import Counter

from reelhouse.llm import spelling
from tests.conftest import SF001
from tests.llm.helpers import awkward, documents


def brute_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_near(words):
    """Near words by the words with one letter taken out."""
    holes = {}
    for w in words:
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} | {f"{i}{w[:i]}?{w[i + 1:]}" for i in range(len(w))}:
            holes.setdefault(key, set()).add(w)
    near = {w: set() for w in words}
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    return near


def brute(rows):
    words = brute_words(rows)
    near = brute_near(words)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), None if f is None else words[f]))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def variants_of(rng):
    """Texts with words, misspellings and chains of misspellings at falling counts."""
    letters = "abcdeé÷ß"
    rows = []
    for k in range(60):
        word, n = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))), 700
        while n >= 4:
            rows.append((k, f"{word.upper() if rng.random() < .2 else word} " * n, "a"))
            at, n = rng.randrange(len(word)), n // rng.choice((4, 5, 6))
            word = rng.choice((word[:at] + word[at + 1:], word[:at] + rng.choice(letters) + word[at:],
                               word[:at] + rng.choice(letters) + word[at + 1:]))
    return rows


def test_awkward_rows_equal_brute_force(spark):
    rows = awkward() + variants_of(random.Random(6)) + [(None, "Naïveté naïvete " * 6, "a"), (7, "xx1yy_ABCDEF" * 5, "a")]
    want = brute([r[:2] for r in rows])
    assert any(w[1] and w[1] != w[2] for w in want)          # a chain of forms
    assert result(spelling.variants(documents(spark, rows, extra=True))) == want


def test_pruned_dictionary_gives_the_same(spark):
    """With many frequent grams, so that index grams have all lengths."""
    rows = variants_of(random.Random(7))
    words = spelling.vocabulary(documents(spark, rows))
    frequent = spelling.frequent_grams(words, least=1)
    assert {len(g) for r in words.collect() for g in spelling.decompose(r.word, frequent)} == {2, 3, 4}
    assert result(spelling.variants(documents(spark, rows).repartition(7), least=1)) == brute([r[:2] for r in rows])


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = result(spelling.variants(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()]) and got


def test_near_words_share_a_merged_list():
    rng = random.Random(8)
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 12)))
        frequent = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 5))): 9 for _ in range(30)}
        at = rng.randrange(len(word) + 1)
        other = rng.choice((word[:at] + word[at + 1:], word[:at] + "b" + word[at:], word[:at] + "c" + word[at + 1:]))
        mine, theirs = (set(spelling.merged_lists(w, frequent)) for w in (word, other))
        letters = {k for k, letter in theirs if letter}
        if len(word) == len(other):
            assert word == other or letters & {k for k, letter in mine if letter}
        else:
            short, long = sorted((mine, theirs), key=len)
            assert {k for k, letter in short if not letter} & {k for k, letter in long if letter}


def test_empty(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, None, "a"), (2, "short", "a")])).count() == 0
