from dossierkit.functions import html as H


def test_unescape(evaluate):
    texts = {
        "a&amp;lt;b": "a&lt;b",
        "&#8364;&#x20AC; &copy;&apos;": "€€ ©'",
        "&bogus; & x &nbsp;|": "&bogus; & x \xa0|",
        "&#0;&#xFFFFFFF;&#55296;": "���",
        "&lpar;&rpar; &NotEqualTilde; &hearts;": "() ≂̸ ♥",
        "it&#146;s 1&#150;2 &#x80; &#129;": "it’s 1–2 € \x81",
        "&": "&",
    }
    assert evaluate(H.unescape("x"), list(texts)) == list(texts.values())


def test_texts(evaluate):
    html = [" <b>Foo</b> <i> bar&nbsp;</i>baz<!-- no --> "]
    assert evaluate(H.stripped_text("x"), html) == ["Foobarbaz"]
    assert evaluate(H.joined_text("x"), html) == ["Foo bar baz"]
    assert evaluate(H.spaced_text("x"), ["a<br>b<b>c</b>"]) == ["a b c"]
    assert evaluate(H.joined_text("x"), ["1 < 2 <b>and</b> 3 > 2"]) == ["1 < 2 and 3 > 2"]


def test_tags_end_behind_their_quotes(evaluate):
    texts = {
        """a<b title="1 > 0">b</b><i x='>' y=">">c""": "abc",
        """<a title="open>x</a> y" z>w""": "w",
        """<p it's>a<br alt='>b""": "ab",
        "1 < 2 > 0<b>c": "1 < 2 > 0c",
        "<a href=x=y>z</a ><!doctype html>": "z",
    }
    assert evaluate(H.joined_text("x"), list(texts)) == list(texts.values())


def test_unclosed_script_hides_the_rest(evaluate):
    assert evaluate(H.drop_noise("x"), ["a<script>b<p>c", "a<SCRIPT>b</script >c"]) == ["a<!>", "a<!>c"]
