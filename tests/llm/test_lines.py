from collections import Counter, defaultdict

from browsekit.llm import lines

from .cases import clashing, empty_docs, odd_docs, prose


def brute(rows, min_sites):
    """(id, n_lines, n_removed, text) from (id, text, site); copies of a text are one page."""
    home = {}
    for _, text, site in rows:
        if text is not None and site is not None:
            home[text] = min(site, home.get(text, site))
    sites = defaultdict(set)
    for text, site in home.items():
        for line in text.split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(site)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    out = Counter()
    for i, text, _ in rows:
        if text is None:
            out[(i, 0, 0, None)] += 1
            continue
        all_ = text.split("\n")
        kept = [x for x in all_ if x.strip(" ") not in bad]
        out[(i, len(all_), len(all_) - len(kept), "\n".join(kept))] += 1
    return out


def check(docs, min_sites):
    got = lines.remove_boilerplate(docs, min_sites=min_sites)
    got = Counter((r["_row"]["doc_id"], r["_n_lines"], r["_n_removed"], r["_text"]) for r in got.collect())
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert got == brute(rows, min_sites)
    return got


def test_odd_rows_and_clashing_names(spark):
    check(odd_docs(spark), 2)
    check(clashing(odd_docs(spark)), 2)
    check(empty_docs(spark), 2)


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 4)


def test_many_sites_far_from_and_near_the_threshold(spark):
    """Lines on 1..400 sites: sketches settle the far ones, exact counts the near ones."""
    rows = []
    for i in range(400):
        shared = [f"shared line number {n} of the footer" for n in (1, 50, 95, 99, 100, 101, 106, 200, 390) if i < n]
        rows.append((i, prose(i, 90) + "\n" + "\n".join(f"  {x} " for x in shared), "en", f"site{i}", 1))
    got = check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 100)
    assert sum(n for (_, _, removed, _), n in got.items() if removed) >= 100


def test_copies_are_one_page_and_short_lines_count(spark):
    """A text copied to every site keeps its lines; a short line on as many pages goes, also
    where it is all there is."""
    copy = "only in this text\nand its copies"
    rows = [(i, copy, "en", f"site{i % 15}", 1) for i in range(60)]
    rows += [(100 + i, f"own line {i}\nMenu\n  \n" + "Menu\n" * (i % 3), "en", f"site{i}", 1) for i in range(12)]
    rows += [(200, "Menu", "en", "site0", 1), (201, "Menu", "en", None, 1)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 10)
    assert sum(n for (i, _, removed, _), n in got.items() if i < 100 and removed) == 0
    assert got[(200, 1, 1, "")] == got[(201, 1, 1, "")] == 1


def test_lists_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", 0)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    assert sum(n for (_, _, removed, _), n in check(docs, 4).items() if removed) > 10
    plan = lines.remove_boilerplate(docs, min_sites=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_cleaned_rows_keep_their_columns(spark):
    docs = clashing(odd_docs(spark))
    out = lines.clean_documents(docs, min_sites=2)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.dtypes == docs.dtypes


def test_main_path_is_native(spark):
    plan = lines.clean_documents(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
