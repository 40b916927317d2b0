from plateward.llm.line_frequency import without_boilerplate

SCHEMA = "page_id bigint, url string, html string, host string, lines string"


def page(k, url, *lines):
    return (k, url, "".join(f"<p>{line}</p>" for line in lines), "x", "y")


def result(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA)
    return {r["page_id"]: r for r in without_boilerplate(pages, **options).collect()}


def test_drops_lines_above_the_share_of_their_own_host(spark):
    rows = [page(k, "http://a.com/x", "menu", f"own {k}", "menu") for k in range(10)]
    rows += [page(20 + k, "https://u@B.com:80/y", "menu" if k < 3 else "other", f"o {k}") for k in range(10)]
    found = result(spark, rows)
    assert found[3]["text"] == "own 3" and found[3]["n_dropped"] == 2
    # Three of ten pages are not more than 30 %.
    assert found[20]["host"] == "b.com" and found[20]["text"] == "menu\no 0"
    assert found[25]["text"] == "o 5"


def test_one_page_proves_nothing_and_two_do(spark):
    assert result(spark, [page(1, "http://a.com", "menu", "menu")])[1]["n_dropped"] == 0
    found = result(spark, [page(k, "http://a.com", "menu", f"own {k}") for k in range(2)])
    assert found[1]["text"] == "own 1" and found[0]["n_dropped"] == 1


def test_awkward_pages(spark):
    rows = [(None, None, None, None, None), (1, None, "<p>menu</p>", "h", "l"), (2, "no url", "", "h", "l")]
    rows += [page(9, "http://a.com/", "m")] * 3
    pages = spark.createDataFrame(rows, SCHEMA)
    found = without_boilerplate(pages).collect()
    assert len(found) == 6
    assert sorted((str(r["page_id"]), r["host"], r["n_kept"], r["text"]) for r in found) == [
        ("1", None, 1, "menu"),
        ("2", None, 0, ""),
        ("9", "a.com", 0, ""),
        ("9", "a.com", 0, ""),
        ("9", "a.com", 0, ""),
        ("None", None, 0, ""),
    ]
    assert without_boilerplate(pages.limit(0)).count() == 0


def test_markup_is_no_text(spark):
    html = "<title>T</title><script>var x='<p>no</p>'</script><!-- c --><style>p{}</style><b>bo</b>ld<br>  next \t line"
    found = result(spark, [(1, "http://a.com", html, None, None)])
    assert found[1]["text"] == "T\nbold\nnext line"
