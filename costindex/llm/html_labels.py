"""Labelled pages that the block classifier is trained on.

Each block's text starts with its label: ``+`` belongs to the main text, ``-``
does not.  The pages are invented; they cover articles with and without
semantic elements, and what surrounds them.
"""

_LONG = "the river rose again in the night and by morning the lower streets were under water so the school stayed closed for the day"
_MID = "people who live near the bridge carried their things upstairs"
_SHORT = "It rained."

PAGES = (
    # semantic page: menu, advert, article with very short and long paragraphs, footer
    f"""<html><head><title>t</title></head><body><nav><ul><li><a href=1>-Home</a></li><li><a href=2>-World news</a></li>
    <li><a href=3>-Sport</a></li></ul></nav><div class="ad">-{_LONG}</div><article><h1>+High water</h1><p>+{_LONG}</p>
    <p>+{_SHORT}</p><p>+{_MID}</p><p>+Yes.</p><p>+{_LONG} {_MID}</p></article><footer>-Imprint {_MID}</footer></body></html>""",
    # advert that is longer than the article
    f"""<body><div class="ad">-{_LONG} {_LONG}</div><article><h1>+Flood</h1><p>+{_SHORT}</p></article>
    <footer>-{_LONG}</footer></body>""",
    # header, sidebar and cookie notice around an article with a link in its text
    f"""<body><header><a href=/>-The Daily</a><p>-News since 1901</p></header><div class="cookie-notice"><p>-{_LONG}</p></div>
    <main><h1>+Bridge closed</h1><p>+{_LONG} <a href=x>see the map</a> {_MID}</p><p>+{_MID}</p><ul><li>+bring warm clothes</li>
    <li>+bring a torch</li></ul></main><aside><h3>-Most read</h3><p>-{_MID}</p><a href=1>-{_MID}</a></aside></body>""",
    # divisions with class names only
    f"""<body><div id="top-menu"><a href=1>-Start</a> <a href=2>Contact</a></div><div class="content"><h2>+Dry summer</h2>
    <div>+{_LONG}</div><div>+{_MID}</div></div><div class="sidebar"><div>-{_MID}</div><div>-{_LONG}</div></div>
    <div class="footer"><div>-{_MID}</div></div></body>""",
    # reader comments below an article, and a form
    f"""<body><article><h1>+Market day</h1><p>+{_LONG}</p><p>+{_MID}</p><blockquote>+{_MID}</blockquote></article>
    <section class="comments"><h3>-3 comments</h3><div>-{_LONG}</div><div>-{_MID}</div><div>-I agree.</div></section>
    <form action=/s><label>-Your name</label><p>-{_MID}</p></form></body>""",
    # comments and related links inside the article element
    f"""<body><article><header><h1>+Old mill</h1></header><p>+{_LONG}</p><p>+{_MID}</p><div class="related"><a href=1>-{_MID}</a></div>
    <div class="share-bar">-Share this</div><div id="comments"><p>-{_LONG}</p></div></article></body>""",
    # no names and no semantic elements: words and links decide
    f"""<body><div><a href=1>-Home</a></div><div><a href=2>-About us</a></div><div><a href=3>-All articles by topic</a></div>
    <p>+{_LONG}</p><p>+{_MID}</p><p>+{_LONG} {_LONG}</p><p>+{_LONG}</p><div><a href=4>-Next page</a></div><div><a href=5>-Terms of use</a></div></body>""",
    f"""<body><table><tr><td><a href=1>-Index</a></td><td><a href=2>-Archive of all years</a></td></tr></table>
    <p>+{_LONG} {_MID}</p><p>+{_SHORT}</p><p>+{_LONG}</p><p><a href=9>-Back to the list of all pages</a></p><p><a href=8>-Print</a></p></body>""",
    # several link lists, newsletter box, pagination
    f"""<body><div class="breadcrumbs"><a href=1>-News</a></div><article><h1>+Harvest</h1><p>+{_LONG}</p><h2>+What comes next</h2>
    <p>+{_LONG}</p></article><div class="newsletter-box"><p>-{_LONG}</p></div><div class="pagination"><a href=1>-1</a> <a href=2>2</a></div>
    <div role="complementary"><p>-{_MID}</p></div></body>""",
    # an article of links in running text, list items and a table
    f"""<body><article><p>+{_MID} <a href=1>{_MID}</a> {_MID}</p><p>+<a href=2>{_SHORT}</a> {_MID}</p><ol><li>+one</li><li>+two {_MID}</li></ol>
    <table><tr><td>+March</td><td>+{_MID}</td></tr></table></article><div class="banner-bottom">-{_MID}</div></body>""",
    # short blocks without names: among link blocks they belong to the frame, among text to the text
    f"""<body><p>-Welcome</p><div><a href=1>-Home</a></div><div><a href=2>-Topics</a></div><p>+{_LONG}</p><p>+{_SHORT}</p><p>+{_MID}</p>
    <p>+{_LONG}</p><div><a href=3>-Older posts</a></div><p>-All rights reserved</p><div><a href=4>-Imprint</a></div></body>""",
    f"""<body><div><a href=1>-Start</a></div><p>-You are here</p><div><a href=2>-Archive</a></div><p>+{_MID}</p><p>+Why?</p><p>+{_LONG}</p>
    <p>+{_SHORT} {_SHORT}</p><p>+{_LONG}</p><div><a href=3>-Top of page</a></div><p>-Page 2 of 9</p><div><a href=4>-Next</a></div><p>-Last change in May</p></body>""",
    f"""<body><div><a href=1>-Start</a></div><p>+{_LONG} {_MID}</p><p>+No.</p><p>+{_LONG}</p><div><a href=5>-Print this page</a></div><p>-Server three</p></body>""",
    # articles of very short blocks
    f"""<body><nav><a href=1>-Home</a></nav><div class="ad">-Buy</div><article><h1>+Thing.</h1><p>+Thing.</p><p>+So.</p><p>+It was.</p>
    <p>+{_MID}</p><p>+No.</p><p>+Yes.</p></article><footer>-{_LONG}</footer></body>""",
    f"""<body><div class="ad">-Two words</div><article><h1>+One</h1><p>+One</p><p>+Two three four five</p><p>+{_LONG}</p><p>+End.</p></article>
    <footer>-Imprint</footer></body>""",
    f"""<body><main><h1>+Word</h1><p>+Another.</p><p>+{_SHORT}</p><p>+{_MID}</p><p>+Last.</p><p>+Bye.</p></main></body>""",
    f"""<body><article><p>+Go.</p><p>+{_MID}</p><div class="related"><a href=1>-More on this</a></div><p>+It is so.</p><p>+Here.</p></article>
    <div><a href=2>-Archive</a></div><p>-Seen by nine</p><div><a href=3>-Top</a></div></body>""",
)
