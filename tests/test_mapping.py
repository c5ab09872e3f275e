import json

from ticketloom.operators import joins, mapping


def test_issue_bodies_and_comments(spark):
    tree = json.dumps({"type": "doc", "content": [{"type": "paragraph", "content": [{"type": "text", "text": "from tree"}]}]})
    issues = spark.createDataFrame(
        [(0, "A-1", "s", "Open", "c", "Bug", tree, "<p>a<br>b &amp; c</p>"), (1, "A-2", "s", "Open", "c", "Bug", tree, None), (2, "A-3", "s", "Open", "c", "Bug", "plain", ""), (3, "A-4", None, None, None, None, None, None)],
        "ord long, key string, summary string, status string, created string, issuetype string, description string, rendered_description string",
    )
    comments = spark.createDataFrame(
        [("A-1", 2, "x", None, "d2", "second", None), ("A-1", 1, "y", "staff", "d1", "", tree), ("A-1", 3, "z", "customer", "d3", "gone", None)],
        "key string, c_ord int, author string, account_type string, created string, rendered_body string, body_tree string",
    )
    rows = {r["ticket_id"]: r for r in mapping.issues_to_tickets(issues, comments, "https://t/").collect()}
    assert [rows[k]["Body"] for k in ("A-1", "A-2", "A-3", "A-4")] == ["a\nb & c", "from tree", "plain", ""]
    assert [(c["UserName"], c["Body"]) for c in rows["A-1"]["kommentare"]] == [("y", "from tree"), ("x", "second")]
    assert rows["A-2"]["kommentare"] == [] and rows["A-1"]["Url"] == "https://t/browse/A-1"


def test_attachment_fields(spark):
    df = spark.createDataFrame([(1, [{"Url": "", "FileUrl": "/a/b.txt", "FileName": None, "Size": None}, {"Url": None, "FileUrl": None, "FileName": "x", "Size": 3}]), (2, None)], "id int, atts array<struct<Url:string,FileUrl:string,FileName:string,Size:bigint>>")
    rows = {r["id"]: r["atts"] for r in mapping.pick_attachment_fields(df, "atts", "https://h").collect()}
    assert [(a["FileName"], a["Url"], a["Size"]) for a in rows[1]] == [("b.txt", "https://h/a/b.txt", 0)] and rows[2] == []


def test_missing_attachments(spark):
    kind = "array<struct<FileName:string,Url:string,Size:bigint>>"
    own = spark.createDataFrame([("1", [("a", "u", 1)]), ("2", []), ("3", None)], f"comment_id string, Attachments {kind}")
    fetched = spark.createDataFrame([("1", [("z", "z", 1)]), ("2", [("b", "v", 2)])], f"comment_id string, Attachments {kind}")
    rows = {r["comment_id"]: [a["FileName"] for a in r["Attachments"]] for r in joins.fill_missing_attachments(own, fetched).collect()}
    assert rows == {"1": ["a"], "2": ["b"], "3": []}


def test_trees_equal_null_and_broken(spark):
    from ticketloom.operators.pages import rich_tree_to_text

    tree = '{"type":"paragraph","content":[{"type":"text","text":"a"}]}'
    df = spark.createDataFrame([(1, tree), (2, None), (3, "{"), (4, tree), (5, "")], "ord long, tree string").coalesce(1)
    assert {r["ord"]: r["tree"] for r in rich_tree_to_text(df, "tree").collect()} == {1: "a", 2: "", 3: "", 4: "a", 5: ""}
