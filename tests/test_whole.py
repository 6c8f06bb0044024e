"""Queries that do the whole job, where the ones beside SQL take what it can express."""


def test_upserts_read_every_event(spark, sf_dir):
    import ledgerlens.queries as own

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    got = own.QUERIES["q46_upsert_conditional"](spark, sf_dir).collect()
    assert sum(int(r["old"] or 0) + int(r["new"] or 0) for r in got) == events.count()
    last = {r["user_id"]: r["value"] for r in events.orderBy("ts", "event_id").collect()}
    assert {r["user_id"] for r in own.QUERIES["q45_upsert"](spark, sf_dir).collect()} == set(last)


def test_html_to_text_equals_unescape(spark, sf_dir):
    import html
    import re

    import ledgerlens.queries as own
    from ledgerlens.functions.text import html_to_text

    def plain(x):
        return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", html.unescape(x.replace("&nbsp;", " ")))).strip()
    pages = {r["page_id"]: plain(r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert {r["page_id"]: r["text"] for r in own.QUERIES["q20_html_to_text"](spark, sf_dir).collect()} == pages
    texts = ["<p>A &amp; B&#39;s&nbsp;&lt;b&gt;x&#x2014;&copy; &amp;amp; &hellip;</p>", "no", "&notareal; &#160;&", "<i>a</i>\n\tb"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", html_to_text("x").alias("t")).collect()
    assert {r["i"]: r["t"] for r in rows} == {i: plain(x) for i, x in enumerate(texts)}


def test_chunks_of_paragraphs_equal_brute_force(spark, tmp_path):
    import random
    import re

    import ledgerlens.queries as own

    def chunks(text, size=3200, overlap=800):
        done, now = [], ""
        for p in (p.strip() for p in re.split(r"\n\s*\n", re.sub(r"\n{3,}", "\n\n", text.replace("\r\n", "\n")).strip())):
            if not p:
                continue
            if len(longer := f"{now}\n\n{p}" if now else p) <= size:
                now = longer
                continue
            done += [now] if now else []
            now = p if len(p) <= size else ""
            at = 0
            while not now:
                done.append(p[at : at + size].strip())
                if at + size >= len(p):
                    break
                at += size - overlap
        return [x for x in [*done, now] if x]
    r = random.Random(4)
    word = lambda n: " ".join(f"w{r.randrange(999)}" for _ in range(n))
    docs = [(i, r.choice(["\n\n", "\r\n\r\n", "\n \n", "\n\n\n\n"]).join(word(r.choice([1, 30, 200, 600, 1700])) for _ in range(r.randrange(1, 9)))) for i in range(30)]
    docs += [(30, ""), (31, "\n\n \n"), (32, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = own.QUERIES["q37_chunk"](spark, str(tmp_path)).collect()
    assert sorted((q["doc_id"], q["chunk_index"], q["content"]) for q in got) == [(i, j, c) for i, t in docs if t for j, c in enumerate(chunks(t))]


def test_resolve_equals_brute_force(spark, sf_dir):
    import ledgerlens.queries as own
    from ledgerlens.operators.resolve import resolve

    members = [(1, "B1", "jon smith", "CA"), (2, "B2", "mcdonald", "TX"), (3, "B3", "ann lee", "NY"), (4, "B4", "ann leeds", "NY"), (5, "B5", "ann leeds", "CA"), (6, "B6", "bo ray", None), (7, "B7", "zed quill", "NY")]
    rows = [("jon smi", "ca", None), ("mc donald", "TX", None), ("mc donald", "NY", None), ("jon smithson", None, None), ("ann le", "NY", None), ("ann l", "CA", None), ("ann leeds", None, None), ("ann leedsx", "NY", None), ("bo ra", None, None),
            ("bo ra", "CA", None), ("x quill", "NY", None), ("anything", None, "b3"), ("jon smith", "CA", "b9"), ("zedquill", None, None), ("", "CA", None), ("j", None, None)]

    def keys(n, st):
        p = n.split(" ")
        own_ = [n] + ([f"{p[0]} {p[-1]}", p[-1]] if len(p) > 1 else [])
        return [k for x in own_ if n for k in ([x, f"{x}|{st}"] if st else [x])]

    def pick(found, st):
        inside = [m for m in found if st and m[3] == st] or found
        return inside[0][0] if len({m[0] for m in inside}) == 1 else None

    def one(n, st, bio):
        st = (st or "").upper()
        if bio:
            return next(((m[0], "bioguide") for m in members if m[1] == bio.upper()), (None, None))
        for k in keys(n, st):
            if got := pick([m for m in members if k in keys(m[2], m[3] or "")], st):
                return got, "key"
        fuzzy = [m for m in members if n and (not st or m[3] == st) and (m[2].replace(" ", "") == n.replace(" ", "") or m[2].startswith(n) or n.startswith(m[2]))]
        got = pick(fuzzy, st) if fuzzy else None
        return (got, "prefix") if got else (None, None)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id int, name string, state string, bioguide string")
    got = {r["row_id"]: (r["member_id"], r["matched_kind"]) for r in resolve(table, spark.createDataFrame(members, "id int, bioguide_id string, name string, state string"), bioguide="bioguide").collect()}
    want = {i: one(*r) for i, r in enumerate(rows)}
    assert got == want and {k for _, k in want.values()} == {"key", "prefix", "bioguide", None}
    every = own.QUERIES["q32_resolve_members"](spark, sf_dir).collect()
    assert len(every) == spark.read.parquet(f"{sf_dir}/orders.parquet").count() and {"key", "bioguide"} <= {r["matched_kind"] for r in every}
    assert "prefix" in {r["matched_kind"] for r in own.QUERIES["q33_prefix_fallback"](spark, sf_dir).collect()}


def test_resolve_broadcasts_nothing(spark, sf_dir):
    """The planner takes exploded keys for as small as the table they come from."""
    import ledgerlens.queries as own

    for name in ("q32_resolve_members", "q33_prefix_fallback"):
        resolved = own.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in resolved.splitlines() if "Join " in x and ("(key#" in x or "_shape#" in x)]
        assert joins and all("strategy=merge" in x for x in joins)


def test_reports_are_searched_once(spark):
    from pyspark.sql import functions as F

    from ledgerlens.operators import ptr

    text = "Acme\u0000 Corp (ACM) [ST] S (partial) 1/2/2024 01/03/2024 SP $15,001 - $50,000 X Bond Fund [MF] P 2/30/2024 2/1/2024 Over $50,000,000 rest [x]"
    docs = spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "doc_id long, text string").withColumns({"source_url": F.lit("u"), "filing_date": F.lit("2030-01-01"), "member_name": F.lit("A")})
    rows = ptr.transactions(docs)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("{6,240}") == 1
    got = [(r["doc_id"], r["line_number"], r["asset_description"], r["ticker"], r["transaction_type"], r["transaction_date"], r["amount_min"], r["owner"]) for r in rows.orderBy("line_number").collect()]
    assert got == [(1, 1, "Acme Corp", "ACM", "sale", "2024-01-02", 15001, "spouse"), (1, 2, "Bond Fund", None, "purchase", "2024-02-30", 50000001, "self")]
    assert [(r["doc_id"], r["n_transactions"]) for r in ptr.parse(docs, F.to_date(F.lit("2031-01-01")))[0].orderBy("doc_id").collect()] == [(1, 1), (2, 0), (3, 0)]


def test_lookup_keys_normalise_each_name_once(spark):
    from pyspark.sql import functions as F

    from ledgerlens.functions.text import lookup_keys

    df = spark.createDataFrame([("Sen. Ana B. Müller", "Ana", "Müller", "ny"), (None, None, "Ostrow", None), ("", "", "", "CA")], "n string, f string, l string, s string").select(lookup_keys("n", "f", "l", "s").alias("k"))
    assert df._jdf.queryExecution().analyzed().toString().count("representative") == 4  # whole, first, last, first and last
    assert [r["k"] for r in df.select(F.col("k")).collect()] == [["ana b muller", "ana b muller|NY", "ana muller", "ana muller|NY", "muller", "muller|NY"], ["ostrow"], []]


def test_fara_rows_shifted_either_way(spark):
    from ledgerlens.operators.fara import PRINCIPAL, repair_principals

    rows = [('NGO "Free and Faithful",03/25/2024"', "UKRAINE", "7383", "03/20/2024", "SIC Group USA LLC", "street 7", "", "Kyiv", "", "", ""),
            ('Saudi Arabia Railways (SAR") ', ' through HIll +Knowlton GMBH"', "10/12/2022", "SAUDI ARABIA", "3301", "11/10/1981", "Hill LLC", "", "New York", "NY", "10001"),
            ("Sound 01/02/2020", "01/02/2020", "MALTA", "12", "01/02/2019", "A LLC", "1 Road", "", "Rome", "", "5"), ("Odd", None, "MALTA", None, None, "A LLC", None, None, None, None, None)]
    want = [('NGO "Free and Faithful', "03/25/2024", "UKRAINE", "7383", "03/20/2024", "SIC Group USA LLC", "street 7", "", "Kyiv", "", ""),
            ('Saudi Arabia Railways (SAR") through HIll +Knowlton GMBH', "10/12/2022", "SAUDI ARABIA", "3301", "11/10/1981", "Hill LLC", "", "New York", "NY", "10001", ""), rows[2], rows[3]]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ", ".join(["i int", *(f"`{c}` string" for c in PRINCIPAL)]))
    assert [tuple(r)[1:] for r in repair_principals(df).orderBy("i").collect()] == want
