"""Base rules and line frequency on rows by hand; the given tables are compared with SQL."""

from fieldsync.llm import quality


def judged(docs):
    return {r.doc_id: r for r in quality.judged(docs).collect()}


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_base_rules(documents, odd_rows):
    rows = [
        (1, "a b#c  $\n\nsame line\nsame line\n same line"),
        (2, " ".join(["x1 x2 x3 x4 x5 x6 x7 x8"] * 2)),
        (3, words("w", 70) + " " + words("w", 10)),
        (4, words("w", 30)),
        (5, "z " * 40),
    ]
    made = judged(documents(rows))
    assert [tuple(made[1])[i] for i in (3, 4, 5, 6, 7)] == [9, 29, 2, 1, 0]
    assert made[2].n_repeat_words == 16 and made[2].base_failed and not made[2].kept
    assert made[3].n_repeat_words == 20 and not made[3].base_failed
    assert made[4].kept and made[5].n_repeat_words == 40
    odd = quality.judged(documents(odd_rows)).collect()
    assert len(odd) == len(odd_rows)
    assert {r.doc_id: r.n_words for r in odd}[7] == 30_000
    assert all(r.base_failed for r in odd if r.doc_id in (1, 2, 3, 4))
    assert quality.judged(documents([])).collect() == []


def test_lines_of_a_host(documents, monkeypatch):
    boiler = "All  Rights " + words("reserved", 40)
    rows = [(i, f"{boiler if i % 2 else boiler.lower().replace('  ', ' ')}\n{words(f'own{i}', 12)}", "h") for i in range(12)]
    rows += [(100 + i, f"{boiler}\n{words(f'rest{i}', 60)}", "h") for i in range(3)]
    rows += [(200, f"{boiler}\n{words('elsewhere', 10)}", "other"), (201, boiler, None)]
    made = judged(documents(rows))
    assert not any(made[i].kept for i in range(12))  # 12 of 54 words are left
    assert all(made[i].kept and made[i].words_removed == 42 for i in (100, 101, 102))
    assert made[200].kept and made[200].words_removed == 0 and made[201].kept


def test_copies_count_once(documents):
    """A text that many documents repeat does not make boilerplate of its own lines."""
    text = "\n".join(words(f"line{k}_", 10) for k in range(5))
    made = judged(documents([(i, text, "h") for i in range(40)] + [(50, text + "\nmore of it", "h")]))
    assert all(r.kept and r.words_removed == 0 for r in made.values())


def test_repeated_rows(documents):
    boiler = words("shared", 30)
    rows = [(i, f"{boiler}\n{words(f'own{i}', 20)}", "h") for i in range(12)]
    made = quality.judged(documents([*rows, rows[0], rows[0]])).collect()
    assert len(made) == 14 and {r.words_removed for r in made} == {30}


def test_shared_lines_of_different_documents(documents):
    """Documents that share many lines and differ in one are different, whatever their hashes."""
    shared = "\n".join(words(f"menu{k}_", 4) for k in range(40))
    made = judged(documents([(i, f"{shared}\n{words(f'own{i}_', 5)}", "h") for i in range(80)]))
    assert all(r.words_removed == 160 and not r.kept for r in made.values())


def test_copies_are_no_part_of_the_host(documents):
    """The share is one of different documents, as the count is."""
    boiler = words("notice", 20)
    rows = [(i, f"{boiler}\n{words(f'own{i}_', 30)}", "h") for i in range(12)]
    made = judged(documents(rows + [(100 + i, words("copy", 25), "h") for i in range(1500)]))
    assert all(made[i].words_removed == 20 for i in range(12)) and made[100].kept


def test_cleaned_texts(documents):
    """Frequent lines go from the text itself; all else stays as it is."""
    boiler = words("Shared", 30)
    rows = [(i, f"{boiler}\n\n own{i}  {words(f'w{i}_', 60)}\r\n{boiler.lower()} \nend{i}\n", "h") for i in range(12)]
    rows += [(50, f"no such line\n\n{words('x', 30)}", "h"), (51, None, "h"), (52, "", "h"), (None, f"{boiler}\none", "h"), (None, f"two\n{boiler}", "h")]
    made = quality.judged(documents(rows)).collect()
    texts = {r.doc_id: r.cleaned for r in made if r.doc_id is not None}
    assert all(texts[i] == f"\n own{i}  {words(f'w{i}_', 60)}\r\nend{i}\n" for i in range(12))
    assert texts[50] == rows[12][1] and texts[51] is None and texts[52] == ""
    assert sorted(r.cleaned for r in made if r.doc_id is None) == ["one", "two"]
    assert all(r.words_removed == 60 and r.kept for r in made if r.doc_id in range(12))


def templated(documents):
    """Documents of one host that share most lines, copies among them, and one without lines."""
    rows = [(i, "\n".join(words(f"menu{k}_", 4) for k in range(30) if (i * 7 + k) % 5) + f"\n{words(f'own{i}_', 9)}", "h") for i in range(200)]
    rows += [(1000 + i, f"{words('copy', 25)}\n{words('of it', 7)}", "h") for i in range(200)] + [(2000, "\n \n", "h"), (2001, None, "h"), (2002, "", "g")]
    return documents(rows)


def test_sql_states_the_rule(documents):
    """Query and SQL on a host where most lines are shared by different documents."""
    import duckdb

    from fieldsync.llm.catalog import ORACLES

    docs = templated(documents)
    documents_ = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    result = duckdb.sql(ORACLES["op3_line_frequency"].replace("FROM documents", "FROM documents_"))
    columns = [c[0] for c in result.description]
    made = {tuple(r) for r in quality.judged(docs).select(*columns).collect()}
    assert made == set(result.fetchall()) and any(r[-1] for r in made) and not all(r[-1] for r in made)


def test_both_ways_agree(documents, monkeypatch, odd_rows):
    """Frequent lines gathered per host or joined by line: the same rows."""
    docs = templated(documents).unionByName(documents(odd_rows))
    gathered = sorted(quality.judged(docs).collect(), key=repr)
    monkeypatch.setattr(quality, "GATHERED_HOST", 1)
    assert sorted(quality.judged(docs).collect(), key=repr) == gathered
