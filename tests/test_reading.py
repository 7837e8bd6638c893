"""Reading a page or a salary text takes no more steps than its tags and dashes call for."""

from pyspark.sql import functions as F

from advertlode.functions.html import _TOKEN, DEFAULT_DETAIL, _read_detail, _rules, _Scanner
from advertlode.functions.salary import salary_range


def test_a_tag_and_its_text_are_one_token():
    page = "før<p class='a>b'>en < to<b>to</b> tre <3</p>fire<br>"
    assert [m.group() for m in _TOKEN.finditer(page)] == ["før", "<p class='a>b'>en < to", "<b>to", "</b> tre <3", "</p>fire", "<br>"]


def test_texts_around_odd_tags():
    scanner = _Scanner(_rules(DEFAULT_DETAIL))
    read = lambda page: _read_detail(page, scanner)
    assert read("<div class=salary>a<br>b<i>c</i>d</div>e")["salary_text"] == "a b c d"
    assert read("<div class=salary>x<SCRIPT>'</div>'</Script>y<style>z</div>z</STYLE>w</div>")["salary_text"] == "x y w"
    assert read("<div class=salary><TextArea><b>1</b></textarea>2<title><p>3</TITLE>4</div>5")["salary_text"] == "<b>1</b> 2 <p>3 4"
    assert read("<div class=salary>1 < 2 <3 <!-- </div> --> 4</ div>5</div>6")["salary_text"] == "1 < 2 <3 4 5"
    assert read("en<ſcript>to</ſcript>tre<Kbd>fire")["blocks"] == ["en tre fire"]


def test_pairs_are_looked_for_where_an_amount_follows_a_dash(column):
    assert "rlike" in str(salary_range(F.col("t"))).lower()
    texts = ["kode 1111 – Leder 500 000", "- 510 000", "kode 1 - 520 000 – kr. 530 000", "540 000\n-\x1cNOK 550 000", "560 000 til 570 000",
             "stil 580 000", "590 – 600 000", "610 000 - kode 2", None]
    assert [tuple(v) for v in column(salary_range, texts)] == [
        (None, None), (510_000,) * 2, (520_000, 530_000), (540_000, 550_000), (560_000,) * 2, (580_000,) * 2, (600_000,) * 2,
        (610_000,) * 2, (None, None)]
    wide = column(lambda t: salary_range(t, mode="extended"), texts)
    assert tuple(wide[4]) == (560_000, 570_000) and tuple(wide[5]) == (580_000,) * 2 and tuple(wide[6]) == (590_000, 600_000)
