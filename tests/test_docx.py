import io
import zipfile

import pytest

from quire.operators import blocks, structure
from quire.sources import docx

NAMES = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
BREAK = '<w:r><w:br w:type="page"/></w:r>'


def r(text, props=""):
    return f'<w:r><w:rPr>{props}</w:rPr><w:t xml:space="preserve">{text}</w:t></w:r>'


def p(body, style="", props=""):
    styled = f'<w:pStyle w:val="{style}"/>' if style else ""
    return f"<w:p><w:pPr>{styled}{props}</w:pPr>{body}</w:p>"


def archive(body, **parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NAMES}><w:body>{body}<w:sectPr/></w:body></w:document>")
        for name, data in parts.items():
            z.writestr({"notes": "word/footnotes.xml", "rels": "word/_rels/document.xml.rels", "png": "word/media/image1.png", "styles": "word/styles.xml"}[name], data)
    return out.getvalue()


def read(body, **parts):
    return docx.decode(archive(body, **parts))


def test_types_tags_and_marks():
    blocks = read(
        p(r("Big"), "Title", '<w:jc w:val="center"/>') + p("") + p(r("One"), "heading 2") + p(r("ten"), "Heading10") + p(r("said"), "Quote") + p(r("x", '<w:rFonts w:ascii="Consolas"/>')) + p(r("y"), "Code")
        + p(r("a", '<w:b/><w:i w:val="0"/>') + r("b", '<w:vertAlign w:val="superscript"/><w:rStyle w:val="CodeChar"/>') + r("")) + "<w:tbl/>",
    )
    assert [(b["type"], b.get("heading_level"), b["text"]) for b in blocks] == [("paragraph", None, "Big"), ("paragraph", None, ""), ("heading", 2, "One"), ("paragraph", None, "ten"), ("blockquote", None, "said"), ("paragraph", None, "x"), ("paragraph", None, "y"), ("paragraph", None, "ab"), ("table", None, "")]
    assert blocks[0]["tags"] == ["centered", "large_font"] and blocks[1]["tags"] == ["empty_line"]
    assert [b.get("preformatted") for b in blocks[5:8]] == [True, True, None]
    assert [s["marks"] for s in blocks[7]["spans"]] == [["bold"], ["superscript", "code"]]
    assert [b["block_id"] for b in blocks[:2]] == ["b_000001", "b_000002"]


def test_sizes():
    size = lambda n: f'<w:sz w:val="{n}"/>'
    blocks = read(p(r("a", size(36))) + p(r("b", size(24)) + r("c", size(24))) + p(r("d", size(18))) + p(r("e")))
    assert [b["tags"] for b in blocks] == [["large_font"], [], ["small_font"], []]
    styles = f'<w:styles {NAMES}><w:docDefaults><w:rPrDefault><w:rPr><w:sz w:val="48"/></w:rPr></w:rPrDefault></w:docDefaults></w:styles>'
    assert [b["tags"] for b in read(p(r("a", size(36))), styles=styles)] == [["small_font"]]


def test_tracked_changes_and_text():
    (block,) = read(p('<w:ins><w:r><w:t>new </w:t></w:r></w:ins><w:del><w:r><w:t>old</w:t></w:r></w:del><w:hyperlink><w:r><w:t>link</w:t><w:tab/><w:noBreakHyphen/><w:softHyphen/><w:br/></w:r></w:hyperlink>'))
    assert block["text"] == "new link\t-\n"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (p(BREAK + r("A")), [("paragraph", "A", True)]),
        (p(r("A") + BREAK) + p("") + p(r("B")), [("paragraph", "A", None), ("paragraph", "", None), ("paragraph", "B", True)]),
        (p(r("A") + BREAK + r("B")), [("paragraph", "A", None), ("page_break", "", None), ("paragraph", "", None), ("page_break", "", None), ("paragraph", "B", None)]),
        (p(BREAK) + p(r("A")), [("paragraph", "", None), ("paragraph", "A", True)]),
        (p(r("A"), props="<w:pageBreakBefore/>"), [("paragraph", "A", True)]),
        (p(r("A"), props='<w:pageBreakBefore w:val="0"/>'), [("paragraph", "A", None)]),
        (p(BREAK) + "<w:tbl/>" + p(r("A")), [("paragraph", "", None), ("table", "", True), ("paragraph", "A", None)]),
        (p(BREAK), [("paragraph", "", None)]),
    ],
)
def test_page_breaks(body, want):
    assert [(b["type"], b["text"], b.get("force_page_break")) for b in read(body)] == want


def test_notes_are_numbered_by_first_reference():
    ref = lambda k: f'<w:r><w:footnoteReference w:id="{k}"/></w:r>'
    notes = f'<w:footnotes {NAMES}><w:footnote w:type="separator" w:id="0"><w:p/></w:footnote><w:footnote w:id="7"><w:p><w:r><w:footnoteRef/></w:r>{r("first")}</w:p><w:p>{r("more")}</w:p></w:footnote><w:footnote w:id="2"><w:p>{r("second")}</w:p></w:footnote><w:footnote w:id="3"><w:p/></w:footnote></w:footnotes>'
    body = p(r("A") + ref(7) + ref(2) + ref(9)) + p(r("B") + ref(7) + ref(3))
    blocks = read(body, notes=notes)
    assert [(b["type"], b["text"], b.get("footnote_ref")) for b in blocks] == [("paragraph", "A12", None), ("footnote", "1 first more", "b_000001"), ("footnote", "2 second", "b_000001"), ("paragraph", "B13", None)]
    assert [b["text"] for b in read(body, notes="<broken")] == ["A", "B"]


def test_figures_and_captions():
    drawing = '<w:r><w:drawing><wp:inline><wp:docPr name="Pic" descr=""/><a:blip r:embed="rId7"/></wp:inline></w:drawing></w:r>'
    rels = '<R><r Id="rId7" Target="media/image1.png"/></R>'
    blocks = read(p(drawing) + p(r("A view"), "Caption") + p(r("Text")), rels=rels, png=b"png")
    assert [b["type"] for b in blocks] == ["paragraph", "image", "paragraph"]
    assert (blocks[1]["figure"]["caption"], blocks[1]["figure"]["alt"], blocks[1]["figure"]["media_name"]) == ("A view", "Pic", "media/image1.png")
    assert [b["type"] for b in read(p(drawing), rels="<broken", png=b"png")] == ["paragraph"]


def test_scan_rejects_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "good.docx").write_bytes(archive(p(r("Chapter 1"), "Heading1") + p(r("Body"))))
    (tmp_path / "bad.docx").write_bytes(b"no archive")
    (tmp_path / "other.PDF").write_bytes(b"%PDF")
    rows = docx.scan_docx(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id.rsplit("/", 1)[1], r.pos, r.text) for r in rows if r.error is None) == [("good.docx", 0, "Chapter 1"), ("good.docx", 1, "Body")]
    errors = {r.doc_id.rsplit("/", 1)[1]: r.error for r in rows if r.error}
    assert set(errors) == {"bad.docx", "other.PDF"} and errors["other.PDF"].endswith("Received: pdf.") and errors["bad.docx"].startswith("BadZipFile")


def test_scan_leaves_large_files_unread(spark, tmp_path, monkeypatch):
    (tmp_path / "large.docx").write_bytes(archive(p(r("Body"))))
    monkeypatch.setattr(docx, "LIMIT", 10)
    (row,) = docx.scan_docx(spark, str(tmp_path)).collect()
    assert (row.error, row.text) == ("file too large", None)


def test_from_a_word_file_to_roles(spark, tmp_path):
    """Chapters that are centred paragraphs with bold runs make a stratum; verbatim paragraphs stay as they are, in text and spans."""
    centre, words = '<w:jc w:val="center"/>', ("ONE", "TWO", "THREE", "FOUR")
    body = "".join(p(r("CHAPTER ", "<w:b/>") + r(" ") + r(w, "<w:b/>"), "", centre) + p(r("A quiet start", "<w:i/>")) + p(r("He  said \"so\"\u200b.")) for w in words)
    (tmp_path / "book.docx").write_bytes(archive(body + p(r('x  =  "y"'), "Code")))
    rows = blocks.curl_quotes(blocks.drop_zero_width(blocks.collapse_space_runs(docx.scan_docx(spark, str(tmp_path)))))
    found = structure.classify(rows).orderBy("pos").collect()
    assert [(b.role, b.number) for b in found if b.pos % 3 == 0 and b.pos < 12] == [("chapter_heading", k + 1) for k in range(4)]
    assert [b.role for b in found if b.pos % 3 == 1] == ["chapter_subtitle"] * 4 and {b.dominant for b in found} == {"paragraph_visual"}
    assert found[2].text == "".join(s.text for s in found[2].spans) == "He said \u201cso\u201d."
    assert found[12].text == "".join(s.text for s in found[12].spans) == 'x  =  "y"'
