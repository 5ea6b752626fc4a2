"""Pages with the cases that the page operators have a defined result for, and their main texts."""

ARTICLE = ("<html><head><title>T &amp; t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
           "<nav><a href='/'>home</a></nav><div class='ad box-1'>buy</div><div id='cookie-notice'>ok?</div>"
           "<article><h1>Head {n} &lt;x&gt;</h1><p>First  <b>bold</b>&nbsp;text {n}<br>more<p>Second\n\tline"
           "<ul><li>one<li>two</ul><form>f</form><!-- <p>no</p> --><div class='comments'><p>nice!</p></div>"
           "</article><aside>side</aside><footer>foot</footer></body></html>")
TEXT = "Head {n} <x>\nFirst bold text {n} more\nSecond line\none\ntwo"
BARE = "<div class='post-7'><p>alone {n}</p></div><div class='sidebar'>links</div>"

CASES = [
    *((i, f"https://www.one.example.com/en/{i}", ARTICLE.format(n=i), TEXT.format(n=i)) for i in range(6)),
    (6, "HTTP://ONE.example.net", BARE.format(n=6), "alone 6"),
    (7, None, ARTICLE.format(n=7), TEXT.format(n=7)), (8, "no scheme", None, ""), (9, "x://", "", ""),
    (None, "http://a.net/es/x?y#z", "<p>unclosed <a href='x>y' title=\"a>b\">link", "unclosed link"),
    (None, "http://a.net/es/x?y#z", "<p>unclosed <a href='x>y' title=\"a>b\">link", "unclosed link"),
    (10, "http://b.org/p\nq?x", "plain &eacute; a < b", "plain é a < b"),
    (11, "http://casinowin.example.org", "<p>" + "long " * 50_000 + "</p>", ("long " * 50_000).strip()),
    (12, "http://deep.org/#", "<div>" * 3_000 + "deep" + "</div>" * 3_000, "deep"),
    (13, "http://cheap-pills.example.org/fr/1", "<nav>only menu</nav>", ""),
]


def rows() -> list[tuple]:
    return [(i, u, h, *["x"] * 6) for i, u, h, _ in CASES]
