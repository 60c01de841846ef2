"""Labelled pages the extraction model is trained on when no others are given.

Written by hand for this purpose. ``data-y`` marks an element and what it holds: 1 main text, 0 the rest. Unmarked
elements take the mark of the element around them; the outermost counts as 0.
"""

LABELLED = (
    """<html><head><title>x</title></head><body><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a
    href=c>Sport</a></li></ul></nav><div class=ad>Buy the best shoes in town today.</div><article data-y=1><h1>A quiet harbour
    town wakes up</h1><p>The boats left before dawn, and by noon the whole street smelled of salt.</p><p>Nobody had
    expected the winter to be so long, said the harbour master. It was the longest in years.</p><p>Short one.</p></article>
    <footer>&copy; 2020 Harbour Press. All rights reserved.</footer></body></html>""",
    """<body><header><h1><a href=/>The Daily</a></h1><form><input><button>Search</button></form></header><main><article
    data-y=1><h1>Rain again</h1><p>It rained for a third day, and the river rose above its banks.</p><figure><figcaption>The
    old bridge under water.</figcaption></figure><h2>What comes next</h2><p>Forecasters expect a dry week.</p>
    <ul><li>Monday will be windy and cold in the north.</li><li>Tuesday brings some sun to the valleys.</li></ul><aside
    data-y=0><h3>Read more</h3><ul><li><a href=1>Ten storms</a></li><li><a href=2>Old floods</a></li></ul></aside></article></main><aside><h3>Most
    read</h3><ol><li><a href=3>Cats</a></li><li><a href=4>Dogs</a></li></ol></aside><section class=comments><h3>Comments</h3><div
    class=comment><p>I think this is a very good report, thank you for it.</p></div><div class=comment><p>The river was
    even higher in my youth, believe me.</p></div></section><footer><p>Contact us. Imprint. Privacy.</p></footer></body>""",
    """<body><div id=menu><ul><li><a href=1>Start</a></li><li><a href=2>Blog</a></li></ul></div><div id=sidebar><h4>Archive</h4><ul><li><a
    href=3>May</a></li><li><a href=4>June</a></li></ul><p>Written by a gardener who likes roses and tea.</p></div><div id=content><div
    class=post data-y=1><h2>How I prune roses</h2><div class=entry><p>Wait until the last frost is over, then cut above
    an outer bud.</p><p>Use clean and sharp shears. Dead wood goes first, then whatever grows inwards.</p><blockquote>A rose
    forgives every cut but the timid one.</blockquote></div></div><div id=respond><h3>Leave a reply</h3><form><label>Name</label><input><label>Your
    comment</label><textarea></textarea><button>Send</button></form></div></div><div id=footer>Powered by a garden shed.</div></body>""",
    """<body><div class=cookie-notice><p>We use cookies to improve your visit. Read our policy.</p><button>Accept</button></div><div
    class=topbar><span>Call us today</span><a href=1>Login</a></div><div class=wrapper><div class=article-body data-y=1><h1>Why the
    clocks differ</h1><p>Two clocks side by side will drift apart within a month.</p><div><p>The pendulum feels the heat of
    the room. A wooden rod feels the damp instead.</p></div><table><tr><td>Brass</td><td>19 parts per million</td></tr><tr><td>Steel</td><td>12
    parts per million</td></tr></table><pre>rate = base + heat * slope</pre></div><div class=share><a href=1>Share</a> <a
    href=2>Tweet</a></div><div class=related-posts><h3>Related</h3><div><a href=1>Sundials of the south</a></div><div><a
    href=2>Water clocks</a></div></div><div class="newsletter signup"><p>Sign up for our weekly letter.</p><form><input><button>Go</button></form></div></div></body>""",
    """<body><nav class=breadcrumb><a href=1>Home</a> &gt; <a href=2>Recipes</a></nav><section class=content data-y=1><h1>Bread for two
    days</h1><p>Flour, water, salt and time are all you need.</p><h2>Ingredients</h2><ul><li>500 g of flour</li><li>350 g of
    water</li><li>10 g of salt</li></ul><h2>Method</h2><ol><li>Mix everything and let it rest for an hour.</li><li>Fold it
    four times, half an hour apart.</li><li>Bake it hot until it sounds hollow.</li></ol><p>It keeps for two days, if nobody
    finds it.</p></section><div class=promo><p>New book out now! Order it with free delivery.</p></div><div id=comments><ul
    class=comment-list><li><p>Mine was flat but tasty. What did I do wrong?</p></li><li><p>Try a hotter oven next time,
    it worked well for me.</p></li></ul></div><footer><ul><li><a href=1>About</a></li><li><a href=2>Terms</a></li></ul></footer></body>""",
    """<body><div class=header><div class=logo>City Museum</div><ul class=nav><li><a href=1>Visit</a></li><li><a
    href=2>Shop</a></li></ul></div><div class=main><div class=text data-y=1><p>The museum holds four thousand maps, most of them drawn by
    hand.</p><p>Some show islands that were never there.</p><p>Others leave out towns that were.</p></div><div class="banner
    sponsor"><p>This page is sponsored by a maker of fine paper.</p></div></div><div class=sidebar><div class=widget><h3>Hours</h3><p>Open
    daily from ten to five.</p></div></div><div class=footer><p>1 Map Street. Phone 123.</p></div></body>""",
    """<html><head><title>t</title><style>p{margin:0}</style><script>var a="<p>";</script></head><body><nav><ul><li><a
    href=/x>uno</a></li><li><a href=/y>dos</a></li><li><a href=/z>tres</a></li></ul></nav><!-- ad --><div class=ad>Texto de un anuncio,
    como tantos otros.</div><article data-y=1><h1>Un pueblo tranquilo</h1><p><b>Las barcas salen al alba y vuelven de noche, dijo el
    hombre.<br><p>Nadie las espera. Nadie las cuenta, porque siempre son las mismas.</p><p>Fin.</p><p><b>El mar no dice nada de
    todo esto.<br></article><footer>&copy; ejemplo &middot; Las barcas salen al alba.</footer></body></html>""",
    """<html><body><nav><ul><li><a href=/x>eins</a></li><li><a href=/y>zwei</a></li></ul></nav><div class=ad>Heute alles billiger, nur
    in diesem Haus.</div><article data-y=1><h1>Der lange Winter</h1><p>Der Schnee kam im Oktober und blieb bis in den
    Mai.</p><p>Wer konnte, blieb im Haus; wer musste, ging hinaus.</p></article><footer>&copy; beispiel &middot; Alle Rechte.</footer>""",
    """<body><header class=site-header><p>News for everyone, every day of the week.</p></header><div role=main><div class=story
    data-y=1><h1>Bees move into the tower</h1><div class=byline data-y=0><a href=1>A. Writer</a></div><p>A swarm has settled under the
    bell, where it is warm and dry.</p><p>The bell will stay silent until the autumn, the council said. Honey
    is to be sold at the fair.</p></div></div><div class=sidebar><p>Advertisement: honey from the valley, a jar for five.</p></div><div
    class=discussion><div class=comment><p>Let them stay for ever, I say.</p></div><div class=comment><p>And who will ring in the
    new year then?</p></div></div><div class=modal><p>Subscribe now and read everything.</p><button>Subscribe</button></div></body>""",
)
