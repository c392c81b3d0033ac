from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb

from eventlake.llm import lines
from eventlake.llm.catalog import QUERIES


def plain(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    covered = {i + k for i in range(len(ws) - 4) if windows[tuple(ws[i : i + 5])] > 1 for k in range(5)}
    failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def figures(df):
    rows = df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return sorted((tuple(r) for r in rows.collect()), key=str)


TEXTS = [
    None, "", " \n\t", "a b c d e f g h i j", "x " * 40, "é😀 #*$%&|<>  nbsp em \x1c fs", "a\n\na\n a\na \nb\r\nb\r",
    " ".join(f"w{i % 7}" for i in range(30)), "one two three four five six one two three four five six seven " + " ".join(f"q{i}" for i in range(80)),
    "long " + " ".join(f"w{i % 4001}" for i in range(260_000)),
]


def test_figures(documents):
    rows = list(enumerate(TEXTS)) + [(None, "a b c"), (3, "a b c")]
    got = figures(lines.quality(documents(rows, ["removed", "kept", "line"])))
    assert got == sorted(((i, *plain(t)) for i, t in rows), key=str)


def test_empty_table(documents):
    assert lines.quality(documents([])).count() == 0
    assert lines.clean(documents([])).count() == 0


def test_query_figures(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = figures(QUERIES["op6_lines"](spark, "/root/testdata/sf0.001"))
    assert got == sorted(((i, *plain(t)) for i, t in rows), key=str)


def prose(key, n):
    letters = str.maketrans("0123456789", "abcdefghij")  # digits are alike in normalised lines
    return " ".join(f"{key}x{i}" for i in range(n)).translate(letters)


def corpus():
    banner = "All  rights RESERVED 2024 by the owners of this site and of all others"
    rows = []
    for i in range(40):
        rows.append((i, f"{prose(i, 60)}\n{banner.replace('2024', str(1000 + i))}"))  # keeps most
    for i in range(40, 60):
        rows.append((i, f"{banner}\n{prose(i, 3)}\n{banner.upper()}"))  # little but the banner
    for i in range(60, 160):
        rows.append((i, f"copied text of one page {prose('c', 30)}\nand a second line {prose('d', 30)}"))
    for i in range(160, 200):
        words = prose("n", 100).split()
        words[i - 160] = prose(f"edit{i}", 1)
        rows.append((i, f"{' '.join(words[:90])}\n{' '.join(words[90:])}"))  # near copies
    return rows


def test_frequent_lines_deplete_documents_but_copies_do_not(documents):
    limits = lines.Limits(max_documents=20)
    rows = corpus()
    out = {r.doc_id: r for r in lines.quality(documents(rows), limits).collect()}
    assert {i for i, r in out.items() if not r.kept} == set(range(40, 60))
    assert all(out[i].n_removed_lines == 1 for i in range(60)) and all(out[i].n_removed_lines == 0 for i in range(60, 200))

    # Whole texts that hold a line, near copies (all of the last 40, and the 100 equal ones) as one.
    by_line = defaultdict(set)
    for i, t in rows:
        for x in t.split("\n"):
            by_line[lines.line_hash(x.encode())].add(i if i < 60 else i // 100 if i < 160 else -1)
    want = {h for h, s in by_line.items() if len(s) > 20}
    measured = lines.measured(documents(rows))
    assert {r.line for r in lines.frequent_lines(measured, documents(rows), limits).collect()} == want

    df = documents(rows, ["removed_", "same_"])
    cleaned = lines.clean(df, limits)
    assert cleaned.columns == df.columns
    kept = {r.doc_id: r for r in cleaned.collect()}
    assert kept[0].text == prose(0, 60) and kept[0].n_chars == len(kept[0].text)
    assert kept[70].text == rows[70][1] and set(kept) == set(range(200)) - set(range(40, 60))


def plain_verdicts(rows, limits):
    """(doc_id, n_left, kept) by comparing the shingle sets of all texts of a host."""
    from test_nearcopies import plain_shingles

    texts = sorted({t or "" for _, t in rows})
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    at = {t: find(i) for i, t in enumerate(texts)}
    holders = defaultdict(set)
    for t in texts:
        for x in t.split("\n"):
            if len(x.split()) >= limits.min_line_words:
                holders[lines.line_hash(x.encode())].add(at[t])
    often = {h for h, s in holders.items() if len(s) > limits.max_documents and len(s) > limits.max_share * len(texts)}
    out = []
    for i, t in rows:
        n, *_, failed = plain(t)
        gone = {}
        for x in (t or "").split("\n"):
            h = lines.line_hash(x.encode())
            if h in often:
                gone[h] = gone.get(h, 0) + len(x.encode().split())
        left = n - sum(gone.values())
        out.append((i, left, not failed and left >= limits.min_left * n))
    return sorted(out)


def test_verdicts_by_brute_force(documents):
    limits = lines.Limits(max_documents=12, max_share=0.02)
    rows = corpus() + [(300 + i, f"{prose('odd', 5)} {i}\n{prose(f'z{i % 9}', 12)}\nof one two three") for i in range(50)]
    got = sorted((r.doc_id, r.n_left, r.kept) for r in lines.quality(documents(rows), limits).collect())
    assert got == plain_verdicts(rows, limits)
    assert any(not kept for *_, kept in got)


def test_hosts_are_apart(spark, documents):
    rows = spark.createDataFrame(
        [(i, f"{prose(i, 30)}\nshared line of words", "en", f"src{i % 30}" if i % 2 else None, 1) for i in range(60)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    out = lines.quality(rows, lines.Limits(max_documents=20)).collect()
    assert {r.doc_id for r in out if r.n_removed_lines} == set(range(0, 60, 2))


def test_documents_of_a_template_differ_and_copies_do_not(documents):
    template = "\n".join(prose(f"t{k}", 16) for k in "abcde")
    rows = [(i, f"{template}\n{prose(f'own{i}', 20)}") for i in range(200)]  # 80 % template
    copy = f"{prose('ta', 16)}\n{prose('page', 80)}\n{prose('only', 20)}"
    rows += [(1000 + i, copy) for i in range(1500)]
    out = {r.doc_id: r for r in lines.quality(documents(rows)).collect()}
    assert all(out[i].n_removed_lines == 5 and not out[i].kept for i in range(200))
    assert all(out[1000 + i].n_removed_lines == 1 and out[1000 + i].kept for i in range(1500))


def test_verdicts_do_not_depend_on_the_size_of_the_host(documents):
    def verdicts(n):
        rows = []
        for i in range(n):
            text = [prose(f"own{i}", 14)]
            text += ["the banner of this site"] * (i % 10 == 0)  # 10 % of the host
            text += ["they all laughed at that"] * (i % 40 == 1)  # 2.5 %
            text += ["Fin.", "Fin.", "Fin."] * (i % 2)
            rows.append((i, "\n".join(text)))
        out = lines.quality(documents(rows)).filter("doc_id < 500").collect()
        return {(r.doc_id, r.n_removed_lines, r.n_left, r.kept) for r in out}

    small = verdicts(500)
    assert small == verdicts(5000)
    assert {i for i, removed, *_ in small if removed} == set(range(0, 500, 10))
