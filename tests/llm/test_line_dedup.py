"""Operator 10 against brute force."""

import random
import re

import numpy as np
import pyarrow as pa

from statlake.llm.line_dedup import Lines, _most_edits, edit_distance, gram_size, line_blocks, line_keys, without_duplicate_lines
from statlake.llm.linking import components, merged
from statlake.llm.queries import op10_line_dedup

from ..conftest import SF_SMALL
from .conftest import odd_rows


def words(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return tuple(w for w in re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]", " ", line).split(" ") if w)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def brute(rows, similarity=0.9, max_bits=3, min_words=5):
    """Texts without repeated lines; how many lines went; how many fuzzy links there are."""
    where, occurrences = {}, []
    for d, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            w = words(line)
            if len(w) >= min_words:
                occurrences.append((d, i, where.setdefault(w, len(where))))
    classes = list(where)
    lines = Lines(pa.array([" ".join(c) for c in classes], pa.string()))
    sim = lines.simhashes(np.arange(len(classes))) if classes else np.zeros(0, np.uint64)
    parent, links = list(range(len(classes))), 0

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(classes)):
        for j in (np.flatnonzero(np.bitwise_count(sim[i + 1 :] ^ sim[i]) <= max_bits) + i + 1).tolist():
            if distance(classes[i], classes[j]) <= (1 - similarity) * max(len(classes[i]), len(classes[j])):
                parent[root(j)], links = root(i), links + 1
    kept, gone = {}, {}
    for d, i, c in occurrences:
        kept[root(c)] = min(kept.get(root(c), (d, i)), (d, i))
    for d, i, c in occurrences:
        if kept[root(c)] != (d, i):
            gone.setdefault(d, set()).add(i)
    text = lambda d, t: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ()))
    return {d: (None if t is None else text(d, t), len(gone.get(d, ()))) for d, t in rows}, links


def test_edit_distance():
    random.seed(1)
    for _ in range(2000):
        a, b = (np.array([random.randint(0, 3) for _ in range(random.randint(0, 12))], "<u4") for _ in range(2))
        assert edit_distance(a, b) == distance(a.tolist(), b.tolist())


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    for bits in (0, 3, 10):
        want, links = brute(rows, similarity=0.9 - 1e-9, max_bits=bits)
        got = {r.doc_id: (r.text, r.n_removed) for r in without_duplicate_lines(docs, max_bits=bits).collect()}
        assert got == want and (links > 5 or bits == 0)


def test_lines_with_small_edits(spark):
    random.seed(6)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for family in range(8):
        line = random.choices(vocabulary, k=120)
        for _ in range(12):
            line = list(line)
            line[random.randrange(len(line))] = random.choice(vocabulary)
            other = " ".join(random.choices(vocabulary, k=9))
            rows.append(" ".join(line).replace("v1", "V1") + ".\n" + other + "\n\nshort line")
    random.shuffle(rows)
    rows = list(enumerate(rows))
    want, links = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.n_removed) for r in without_duplicate_lines(df).collect()}
    assert got == want and links > 40
    # unrelated and short lines stay
    assert all(t.count("\n") >= 2 for t, _ in got.values())


def test_odd_rows(spark, odd, empty):
    out = without_duplicate_lines(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_removed"]
    rows = odd_rows()
    want, _ = brute([r[:2] for r in rows if r[0] is not None and r[0] != 5])
    names = odd.columns
    plain = out.toDF(*[f"c{i}" for i in range(len(names))], "n_lines", "n_removed").collect()
    assert len(plain) == len(rows)
    for r in plain:
        if r.c0 in want:
            assert (r.c1, r.n_removed) == want[r.c0]
            assert r.c4 == (len(r.c1) if r.n_removed else next(x[4] for x in rows if x[0] == r.c0))
    texts = sorted(0 if r[1] is None else r[1].count("\n") + 1 for r in rows)
    assert sorted(r.n_lines for r in plain) == texts
    # rows equal in id and text are one document
    assert len({(r.c1, r.n_removed) for r in plain if r.c0 == 5}) == 1
    assert without_duplicate_lines(empty).count() == 0
    copies = spark.createDataFrame([(1, "one line of six words here"), (2, "One line, of six words here!"), (3, "")], "doc_id long, text string")
    left = without_duplicate_lines(copies, drop_emptied=True).collect()
    assert sorted(r.doc_id for r in left) == [1, 3]


def test_whole_table_on_edit_similarity_alone(spark, monkeypatch):
    """The query against all pairs of lines, whatever their SimHashes."""

    def fast(a, b):
        if 10 * min(len(a), len(b)) < 9 * max(len(a), len(b)):
            return len(a) + len(b)
        number = {w: i for i, w in enumerate({*a, *b})}
        return edit_distance(*(np.array([number[w] for w in x], "<u4") for x in (a, b)))

    monkeypatch.setitem(globals(), "distance", fast)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want, links = brute(rows, similarity=0.9 - 1e-9, max_bits=64)
    got = {r.doc_id: (r.text, r.n_removed) for r in op10_line_dedup(spark, SF_SMALL).collect()}
    assert got == want and links > brute(rows)[1]


def test_complete_finds_all_that_is_alike(spark):
    """Against brute force on edit similarity alone, at lengths where SimHashes differ in many bits."""
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = []
    for n in (9, 10, 12, 18, 20, 27, 30, 40, 63, 100, 120, 700):
        for _ in range(6):
            line = random.choices(vocabulary, k=n)
            other = list(line)
            for _ in range(max(1, n // 10)):
                i = random.randrange(len(other))
                kind = random.choice("sid") if n != 10 else "s"
                other[i : i + (kind != "i")] = [] if kind == "d" else [random.choice(vocabulary)]
            rows += [" ".join(line), " ".join(other), " ".join(random.choices(vocabulary, k=n))]
    rows = list(enumerate(rows))
    alike = [(i, i + 1) for i in range(0, len(rows), 3) if 10 * distance(rows[i][1].split(), rows[i + 1][1].split()) <= max(len(rows[j][1].split()) for j in (i, i + 1))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = lambda **more: {r.doc_id for r in without_duplicate_lines(df, **more).collect() if r.n_removed}
    got, before = found(complete=True), found()
    print(f"recall {len(got & {j for _, j in alike})} of {len(alike)}, by SimHash alone {len(before)}")
    assert got == {j for _, j in alike} and len(alike) > 40 and len(before) < len(got) // 2


def test_lines_alike_share_a_key_and_their_firm_bits():
    """Random edits up to the limit, also at one place and at the ends, for several similarities."""
    random.seed(11)
    for similarity in (0.9, 0.8, 0.95):
        q = gram_size(similarity, 5)
        pairs = []
        for n in [*range(5, 45), 60, 99, 100, 101, 250]:
            for _ in range(12):
                a = [f"w{random.randrange(500)}" for _ in range(n)]
                b = list(a)
                for _ in range(int((1 - similarity) * n + 1e-9)):
                    i = random.choice([0, len(b) - 1, len(b) // 2, random.randrange(len(b))])
                    kind = random.choice("sid")
                    b[i : i + (kind != "i")] = [] if kind == "d" else [f"w{random.randrange(500)}"]
                if a != b and len(b) >= 5 and distance(a, b) <= (1 - similarity) * max(len(a), len(b)) + 1e-9:
                    pairs.append((a, b))
        lines = Lines(pa.array([" ".join(x) for p in pairs for x in p]))
        some = np.arange(len(lines.words))
        of, key = line_keys(lines, some, similarity, q)
        sim, firm = lines.firm_simhashes(some, _most_edits(lines.words, similarity))
        odd = lines.odd_words(some)
        for i in range(0, len(some), 2):
            assert set(key[of == i].tolist()) & set(key[of == i + 1].tolist()), pairs[i // 2]
            assert not (sim[i] ^ sim[i + 1]) & (firm[i] | firm[i + 1])
            assert np.bitwise_count(odd[i] ^ odd[i + 1]).sum() <= 2 * distance(*pairs[i // 2])
        assert len(pairs) > 300 and (firm != 0).mean() > 0.5


def test_numbered_words_tell_counts_apart():
    """Lines of few different words: an edit turns two bits at most, and what counts differ by is seen."""
    rng, names = random.Random(8), [f"w{i}" for i in range(12)]
    base = rng.choices(names, k=400)
    texts, edits = [" ".join(base)], [0]
    for n in range(1, 40):
        words = list(base)
        for _ in range(n):
            words[rng.randrange(len(words)) : rng.randrange(len(words))] = []
            words = words if len(words) > 330 else list(base)
            words[rng.randrange(len(words))] = rng.choice(names)
        texts.append(" ".join(words))
    lines = Lines(pa.array(texts))
    odd = lines.odd_words(np.arange(len(texts)), 8, numbered=True)
    bits = np.bitwise_count(odd ^ odd[0]).sum(axis=1)
    for i in range(1, len(texts)):
        a, b = lines.h[lines.at[0] : lines.at[1]], lines.h[lines.at[i] : lines.at[i + 1]]
        assert bits[i] <= 2 * edit_distance(a, b) - abs(len(a) - len(b))
    # 60 places of one word are another's instead: without numbers no bit turns
    lines = Lines(pa.array(["x " * 100 + "y " * 100, "x " * 160 + "y " * 40]))
    both = np.arange(2)
    assert not (lines.odd_words(both)[0] ^ lines.odd_words(both)[1]).any()
    numbered = lines.odd_words(both, 8, numbered=True)
    assert np.bitwise_count(numbered[0] ^ numbered[1]).sum() > 80


def test_later_links_join_groups(spark):
    """Groups joined by their labels are those of all links at once."""
    rng = random.Random(4)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(330)]
    first, second = (spark.createDataFrame(x, "a bigint, b bigint") for x in (links[:150], links[150:]))
    got = merged(components(first), second).collect()
    want = components(first.unionByName(second)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    none = first.limit(0)
    assert sorted(map(tuple, merged(components(none), first).collect())) == sorted(map(tuple, components(first).collect()))
    assert sorted(map(tuple, merged(components(first), none).collect())) == sorted(map(tuple, components(first).collect()))


def test_a_key_needs_lines_of_like_length(spark):
    """A block has only lines with another there whose number of words allows the similarity."""
    shared = "alpha beta gamma delta epsilon zeta eta theta iota"
    texts = [shared, shared + " kappa", shared + " " + " ".join(f"u{i}" for i in range(11)), shared + " " + " ".join(f"v{i}" for i in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digest = Lines(pa.array(texts)).digests().tolist()
    assert {r.node for r in line_blocks(docs, 0.9, 5).collect()} == set(digest[:2])
