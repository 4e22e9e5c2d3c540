"""Pages written by hand, as sites make them, with their main text: nothing here comes from the generator that trains the labeller."""

PAGES = [
    # a news story in a wrapper of divs
    (
        """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Harbour wall to be raised</title><style>.a{color:red}</style></head><body class="home single">
<div id="masthead"><div class="logo"><a href="/">The Coast Courier</a></div><ul class="menu"><li><a href="/local">Local</a></li><li><a href="/sport">Sport</a></li><li><a href="/contact">Contact</a></li></ul></div>
<div id="content"><div class="post"><h1 class="post-title">Harbour wall to be raised by a metre</h1>
<div class="post-body"><p>The town council voted on Tuesday to raise the harbour wall by a metre, after two winters in which the sea reached the fish market.</p>
<p>Work is to begin in <em>early spring</em> and should take about nine months, said the engineer in charge, who expects <a href="/costs">the costs</a> to stay within the plan.</p>
<p>Shop owners along the quay had asked for a later date, so that the summer season would not be lost. &ldquo;We will keep the promenade open,&rdquo; the mayor promised.</p></div></div></div>
<div class="sidebar widget-area"><h3>Most read</h3><ul><li><a href="/1">Ferry late again</a></li><li><a href="/2">New bakery opens</a></li></ul></div>
<div id="footer"><p>&copy; 2021 The Coast Courier. All rights reserved.</p><a href="/privacy">Privacy policy</a></div></body></html>""",
        "Harbour wall to be raised by a metre The town council voted on Tuesday to raise the harbour wall by a metre, after two winters in which the sea reached the fish market. "
        "Work is to begin in early spring and should take about nine months, said the engineer in charge, who expects the costs to stay within the plan. "
        "Shop owners along the quay had asked for a later date, so that the summer season would not be lost. “We will keep the promenade open,” the mayor promised.",
    ),
    # semantic tags, a cookie notice, adverts between paragraphs, and readers' comments
    (
        """<body><div class="cookie-notice"><p>We use cookies to make this site better. By going on you accept them.</p><button>Accept</button></div>
<header role="banner"><a class="brand" href="/">Bread &amp; Salt</a><nav><a href="/recipes">Recipes</a><a href="/about">About</a></nav></header>
<main><article><header><h1>A rye loaf for beginners</h1></header><p>Rye flour needs more water than wheat does, and much less kneading. Stir it, leave it, and stir it once more before you go to bed.</p>
<div class="advertisement"><a href="http://shop.example.com">Sharp knives, half price</a></div>
<h2>What you need</h2><ul><li>Five hundred grams of whole rye flour.</li><li>Ten grams of salt, and a cup of sourdough that has been fed the day before.</li></ul>
<p>Bake it in a tin for an hour, until the crust is dark. It cuts best on the second day, when the crumb has set.</p></article>
<section id="comments" class="comments-area"><h3>3 comments</h3><div class="comment"><p>Mine came out flat, what did I do wrong?</p></div><div class="comment"><p>Thank you, we loved it!</p></div>
<form class="comment-form"><label>Leave a reply</label><textarea name="c">Your comment</textarea><input type="submit" value="Send"></form></section></main>
<aside class="related"><h4>You may also like</h4><a href="/x">Soda bread in an hour</a></aside><footer class="site-footer"><p>Made with care since 2009</p></footer></body>""",
        "A rye loaf for beginners Rye flour needs more water than wheat does, and much less kneading. Stir it, leave it, and stir it once more before you go to bed. What you need "
        "Five hundred grams of whole rye flour. Ten grams of salt, and a cup of sourdough that has been fed the day before. Bake it in a tin for an hour, until the crust is dark. "
        "It cuts best on the second day, when the crumb has set.",
    ),
    # unclosed paragraphs in upper case, as old pages have them
    (
        """<HTML><BODY BGCOLOR="#FFFFFF"><DIV CLASS="nav"><A HREF="index.html">Home</A> | <A HREF="links.html">Links</A></DIV>
<DIV CLASS="content"><H1>Notes on the night sky</H1><P>In the first week of the month the four bright moons can be seen with any pair of binoculars, if you rest your elbows on a wall.
<P>Look to the south an hour after sunset. The planet stands a hand's width above the trees, and does not twinkle as the stars around it do.
<P>Bring a red lamp: white light spoils the eye's patience for half an hour.</DIV>
<DIV CLASS="footer">Last changed 3 May 1999. Mail the webmaster.</DIV></BODY></HTML>""",
        "Notes on the night sky In the first week of the month the four bright moons can be seen with any pair of binoculars, if you rest your elbows on a wall. "
        "Look to the south an hour after sunset. The planet stands a hand's width above the trees, and does not twinkle as the stars around it do. "
        "Bring a red lamp: white light spoils the eye's patience for half an hour.",
    ),
    # another language, scripts inside, breadcrumbs and a newsletter form
    (
        """<body><nav class="breadcrumb"><a href="/">Start</a> &raquo; <a href="/wandern">Wandern</a></nav><div class="container"><div class="article"><h1>Über den Grat zur Hütte</h1>
<p>Der Weg beginnt hinter der Kapelle und steigt zuerst gemächlich durch lichten Lärchenwald. Nach einer Stunde erreicht man die Alm, wo es frische Milch gibt.</p>
<script>track("<p>view</p>");</script><p>Danach wird es steil: bei Nässe sollte man den unteren Steig nehmen, der zwar länger ist, aber keine Ketten hat.</p>
<p>Von der Hütte sieht man an klaren Tagen bis zum See. Übernachten kann, wer sich vorher anmeldet.</p></div>
<div class="newsletter"><form><p>Abonnieren Sie unseren Newsletter!</p><input type="email"><button>Anmelden</button></form></div></div><footer><p>Impressum | Datenschutz</p></footer></body>""",
        "Über den Grat zur Hütte Der Weg beginnt hinter der Kapelle und steigt zuerst gemächlich durch lichten Lärchenwald. Nach einer Stunde erreicht man die Alm, wo es frische Milch gibt. "
        "Danach wird es steil: bei Nässe sollte man den unteren Steig nehmen, der zwar länger ist, aber keine Ketten hat. "
        "Von der Hütte sieht man an klaren Tagen bis zum See. Übernachten kann, wer sich vorher anmeldet.",
    ),
    # a menu and nothing else
    ("""<body><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul></nav><footer>&copy; 2020 Nobody</footer></body>""", ""),
    # a quotation and a table in the text, sharing links below it
    (
        """<body><div class="header"><a href="/">Garden diary</a></div><div id="main"><article class="entry"><h2>Why the beans failed</h2><p>Every gardener has a year in which nothing climbs. Ours was the one before last, and the reason was plain once we had dug.</p>
<blockquote><p>Beans want warm feet, my grandmother used to say, and a wet head.</p></blockquote><p>We had given them the opposite: a bed in the shade of the shed, and a dry wall behind it. The soil was cold until the middle of June.</p>
<p>This year they stand by the gate, and the first flowers are open.</p></article><div class="share-buttons"><a href="#">Share</a><a href="#">Tweet</a><a href="#">Print</a></div>
<div class="related-posts"><h3>Related posts</h3><ul><li><a href="/p">Sowing peas</a></li></ul></div></div><div class="footer"><p>Copyright 2018. Terms of use.</p></div></body>""",
        "Why the beans failed Every gardener has a year in which nothing climbs. Ours was the one before last, and the reason was plain once we had dug. "
        "Beans want warm feet, my grandmother used to say, and a wet head. We had given them the opposite: a bed in the shade of the shed, and a dry wall behind it. "
        "The soil was cold until the middle of June. This year they stand by the gate, and the first flowers are open.",
    ),
]
