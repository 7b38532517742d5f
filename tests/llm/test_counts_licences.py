import random

import pytest
import tokenizers
from lodestar.llm import licences, queries, token_counts
from tests.llm.fixtures import documents


def brute(lengths):
    n = len(lengths)
    for x in sorted(set(lengths)):
        longer = [y for y in lengths if y >= x]
        yield x, lengths.count(x), len(longer), sum(longer), sum(min(x, y) for y in lengths), sum(y <= x for y in lengths) / n, n, sum(lengths)


def test_token_counts_equal_brute_force(spark, sf):
    library = tokenizers.Tokenizer.from_file(queries.vocabulary())
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), documents(spark)):
        lengths = [len(library.encode(d.text or "", add_special_tokens=False).ids) for d in docs.collect()]
        table = token_counts.token_counts(docs, queries.vocabulary()).persist()
        assert sorted(map(tuple, table.collect())) == list(brute(lengths))
        cut, level = token_counts.answers(table, [0, 1, 100, 101, 10**9], [0.25, 0.5, 1.0])
        assert cut == {x: sum(min(x, y) for y in lengths) for x in cut}
        assert level == {q: min(x for x in lengths if sum(y <= x for y in lengths) >= q * len(lengths)) for q in level}
    assert token_counts.token_counts(documents(spark, []), queries.vocabulary()).collect() == []


def brute_licences(text):
    """Each line with each template: fewest differing words over all runs of the line's words."""
    for i, line in enumerate((text or "").split("\n")):
        found = []
        for name, wording in licences.TEMPLATES.items():
            t, b = licences.words(wording), licences.words(line)
            if any(b[j : j + len(t)] == t for j in range(len(b))):
                found.append(name)
        for name in found:
            yield i, name


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_licences_equal_exact_search(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()
    want = {(d.doc_id, *x) for d in docs for x in brute_licences(d.text)}
    got = queries.op7_licences(spark, f"/root/testdata/{folder}").collect()
    assert want and {(r.doc_id, r.line, r.licence) for r in got} == want
    assert all(r.exact and r.reduction > 0 for r in got)


def test_licences_changed_wordings_and_awkward_rows(spark):
    filler = " ".join(random.Random(1).choices(["some", "other", "plain", "words"], k=3000))
    rows = [
        (1, "x\nThis work is licensed under the GNU General Public Licence, version 3.", None, None, None),
        (2, f"{filler} released under the MIT license. {filler}", None, None, None),
        (3, "A driver has a license for a car and a permit.", None, None, None),
        (4, None, None, None, None),
        (None, "LICENSED UNDER CC BY-NC 4.0.", None, None, None),
    ]
    got = {(r.doc_id, r.line, r.licence, r.differing_words) for r in licences.scan_licences(documents(spark, rows)).collect()}
    assert got == {(1, 1, "GPL-3.0", 1), (2, 0, "MIT", 0), (None, 0, "CC-BY-NC-4.0", 0)}
    assert licences.scan_licences(documents(spark)).collect() == [] and licences.scan_licences(documents(spark, [])).collect() == []


def test_difference_counts_words():
    assert licences.difference("a b c".split(), "x a b c y".split())[0] == 0
    assert licences.difference("a b c".split(), "x a c y".split())[0] == 1
    assert licences.difference("a b c".split(), "a q b c".split())[0] == 1


def test_every_licence_of_a_line_is_reported(spark):
    wording = licences.TEMPLATES
    rows = [
        (1, "This program is licensed under the GNU General Public License, version 9, and the docs under other terms. Released under the MIT License.", None, None, None),
        (2, f"{wording['Apache-2.0']} {wording['MIT']}", None, None, None),
        (3, " ".join(wording.values()), None, None, None),
    ]
    got = [(r.doc_id, r.licence) for r in licences.scan_licences(documents(spark, rows)).collect() if r.exact]
    assert sorted(got) == sorted([(1, "MIT"), (2, "Apache-2.0"), (2, "MIT"), *((3, n) for n in wording)])


@pytest.mark.parametrize("end", ["\n", "\r\n * ", "\r# "])
def test_wrapped_wordings_are_found(spark, end):
    rows, want = [], []
    for name, wording in licences.TEMPLATES.items():
        parts = wording.split()
        for i in range(1, len(parts)):
            rows.append((len(rows), f"first line{end}{' '.join(parts[:i])}{end}{' '.join(parts[i:])}{end}last", None, None, None))
            want.append((len(want), 1, name, 0))
    rows.append((len(rows), end.join(["x", *licences.TEMPLATES["BSD-3-Clause"].split()]), None, None, None))
    want.append((len(want), 1, "BSD-3-Clause", 0))
    got = [(r.doc_id, r.line, r.licence, r.differing_words) for r in licences.scan_licences(documents(spark, rows)).collect()]
    assert sorted(got) == want
