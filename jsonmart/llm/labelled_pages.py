"""Pages with labels, written for this package: data-main marks the elements whose text is the article.

They show layouts with and without <article> or <main>, menus as lists and as plain elements, tables, and the usual kinds of page furniture under their usual names; the extractor's weights are counted from them.
"""

PAGES = (
    """<html><head><title>River report</title><style>p{color:red}</style></head><body>
    <header class="site-header"><a href="/">The Daily Gazette</a><p>All the news of the valley</p></header>
    <nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">Sport</a></li><li><a href="/c">Weather</a></li></ul></nav>
    <div class="cookie-notice" role="alert"><p>We use cookies to improve this site.</p><button>Accept</button></div>
    <div class="ad">Buy a new bicycle today and save ten per cent.</div>
    <article data-main><h1>River rises after a week of rain</h1><p>The river rose by two metres on Monday, and the lower
    road was closed until the evening.</p><p>Farmers moved their cattle to the hills before the water came.</p></article>
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Bridge opens</a></li><li><a href="/y">New school</a></li></ul></aside>
    <section class="comments" id="comments"><h3>Comments</h3><p class="comment">Our cellar was full of water too.</p></section>
    <footer class="footer"><p>Copyright The Daily Gazette. All rights reserved.</p></footer></body></html>""",
    """<html><body><div id="top-bar" class="banner"><p>Subscribe now for one coin a month</p></div>
    <div id="navigation" class="navbar"><a href="1">News</a> <a href="2">Culture</a> <a href="3">Contact</a></div>
    <div class="breadcrumb breadcrumbs"><a href="/">Home</a> / <a href="/travel">Travel</a></div>
    <div id="content" class="post-content" data-main><h1>Walking the old salt road</h1><p>The road starts behind the mill
    and climbs through beech woods for an hour.</p><h2>What to bring</h2><ul><li>good shoes for wet stones</li><li>water for
    half a day</li></ul><blockquote><p>Nobody hurries on this road, the miller says.</p></blockquote></div>
    <div class="share social"><a href="t">Tweet</a> <a href="f">Share</a> <a href="m">Mail</a></div>
    <div class="related related-posts"><h4>You may also like</h4><a href="q">Ten walks by the sea</a></div>
    <form class="newsletter subscribe" action="/s"><label>Mail address</label><input name="m"><button>Sign up</button></form>
    <div id="disqus_thread" class="comment-list"><div class="comment reply"><p>Walked it last spring and loved it.</p></div></div>
    <div id="footer"><p>Imprint. Privacy. Terms of use.</p></div></body></html>""",
    """<html><body><table class="layout"><tr><td class="left menu"><a href="a">Start</a><br><a href="b">Products</a></td>
    <td class="main" data-main><p>The workshop makes clocks since the time of the great fire, all of them by hand.</p>
    <p>Each clock takes three months, and the wood is dried for five years.</p></td>
    <td class="right sidebar widget"><b>Offers</b><p>Oak clock now cheaper</p></td></tr></table>
    <div class="advert advertisement sponsored promo"><p>Sponsored: insure your house with us.</p></div>
    <div class="copyright legal disclaimer"><p>No liability for linked pages.</p></div></body></html>""",
    """<html><body><div role="banner" class="masthead"><p>Science for all</p></div><div role="navigation"><a href="x">Topics</a>
    <a href="y">Authors</a></div><main role="main" data-main><h1>Why leaves fall</h1><p>In autumn a layer of cork grows at the
    foot of each leaf and cuts it off from the branch.</p><figure><figcaption>A leaf scar under the lens</figcaption></figure>
    <pre>cork cells: 12</pre><p>The tree saves water that way, since roots drink little from cold ground.</p></main>
    <div role="complementary" class="widget-area"><p>Follow the magazine</p></div><div class="consent gdpr popup modal overlay">
    <p>Your privacy matters to us and our partners.</p></div><div role="contentinfo"><p>Printed on recycled paper</p></div>
    <form role="search" class="search login"><input><button>Find</button></form><div class="pagination pager"><a href="2">Next</a>
    </div><div class="tags taglist"><a href="t">autumn</a></div><noscript>Please enable scripts.</noscript></body></html>""",
    """<html><body><div class="nav"><a href="1">Start</a> <a href="2">Archive</a> <a href="3">Imprint</a></div>
    <div class="container"><div class="row"><section class="story text" data-main><div class="title"><h1>The ferry stops at noon</h1></div>
    <div class="inner"><p>For ninety years the ferry has crossed the lake at every full hour of the day.</p><p>From May on the
    last boat leaves at noon, as the company finds no second captain.</p></div></section></div></div>
    <div class="sidebar"><h3>Popular</h3><p>Ten lakes to see</p></div>
    <div class="comments"><div class="comment"><p>My uncle was captain there.</p></div><div class="comment"><p>A pity.</p></div></div>
    <div class="footer"><p>Printed in the valley since long ago</p></div></body></html>""",
    """<html><body><div id="header"><h2>Garden letters</h2></div><div id="menu"><a href="a">Beds</a> <a href="b">Trees</a></div>
    <div class="wrap page" data-main><div class="entry body"><h1>Sowing beans late</h1><section class="section"><p>Beans sown in July
    still ripen if the autumn stays warm and the soil is loose.</p></section><section class="section box"><p>Water them in
    the morning, never at night, and cover them when frost is near.</p></section></div></div>
    <div id="respond"><h3>Leave a reply</h3><form><label>Name</label><input><textarea></textarea></form></div>
    <ol class="replies"><li><p>Mine froze.</p></li><li><p>Which sort did you sow?</p></li></ol>
    <div class="sponsor"><p>Seeds by mail, cheaper than ever</p></div><div id="footer"><p>Written in the shed</p></div></body></html>""",
    """<html><body><header><a href="/">Town hall</a></header><nav><ul class="nav"><li><a href="1">Offices</a></li>
    <li><a href="2">Dates</a></li></ul></nav><div class="alert" role="alert"><p>Offices closed on Friday.</p></div>
    <main data-main><h1>New rules for the market</h1><p>Stalls may open at six in the morning from the first of June on.</p>
    <table><tr><th>Place</th><th>Fee</th></tr><tr><td>Square</td><td>four crowns</td></tr></table><p>Dealers from other towns
    ask at the office on the ground floor.</p><dl><dt>Hours</dt><dd>eight to twelve</dd></dl></main>
    <aside><p>Lost property: see list</p></aside><div class="discussion"><p>Six is far too early for us who live there!</p></div>
    <footer><p>Legal notice</p></footer></body></html>""",
    """<html><body><div class="topnav"><a href="1">All</a> <a href="2">Films</a> <a href="3">Books</a></div>
    <div class="promo"><p>Read three months for the price of one</p></div><div class="post content" data-main>
    <h1>A book about rivers</h1><h2>Four hundred pages of water</h2><p>The author walked along nine rivers from spring to mouth.</p>
    <ol><li>She starts with the smallest.</li><li>She ends at the sea.</li></ol><p>It is a quiet book, and a very good one.</p></div>
    <div class="related"><p>More reviews of the week</p></div><div class="comments"><h3>Two comments</h3><p>Too long for me.</p></div>
    <div class="feedback"><p>Was this page helpful?</p></div><div class="newsletter"><p>Our letter, each Monday</p></div></body></html>""",
    """<html><body><center><table><tr><td class="menu"><a href="1">Home</a><a href="2">Recipes</a></td></tr>
    <tr><td data-main><h1>Bread without haste</h1><p>Mix flour, water and salt, and let them stand for a day and a night.</p>
    <p>Bake in a hot oven till the crust is dark, then let it cool for an hour.</p></td></tr>
    <tr><td class="footer"><p>Best seen with any browser</p></td></tr></table></center></body></html>""",
    """<html><body><div class="cookie"><p>Cookies help us to serve you.</p></div><div class="site-nav"><ul class="menu"><li><a href="1">
    Forum</a></li></ul></div><div class="breadcrumbs"><a href="/">Forum</a> / <a href="/q">Questions</a></div>
    <div class="article body" data-main><h1>How to mend a wooden oar</h1><p>Clean the crack, warm the glue, and press it into the
    wood with a thin blade.</p><p>Bind the place with cord and leave it for two days in a dry room.</p></div>
    <div class="advertisement"><p>Boats for every purse</p></div><ul class="comments"><li class="comment"><p>It worked for me.</p></li>
    <li class="comment"><p>Mine broke again.</p></li></ul><div class="share"><a href="s">Share</a></div>
    <div class="login"><form><input><button>Log in</button></form></div><div class="copyright"><p>All rights kept</p></div></body></html>""",
    """<html><body><div role="navigation" class="navigation"><a href="1">North</a> <a href="2">South</a></div>
    <div class="col"><section class="story" data-main><h1>Snow on the pass</h1><p>The road over the pass is closed from tonight on until
    the ploughs have cleared it.</p><figure><figcaption>The pass in an earlier winter</figcaption></figure><p>Drivers take the
    tunnel, which costs nine crowns a car.</p><blockquote>We have never seen so much, says the keeper.</blockquote></section></div>
    <div class="tags"><a href="t">snow</a></div><div class="pagination"><a href="2">Next</a></div>
    <section id="comments"><p>Use the train.</p></section><div class="social"><a href="f">Follow us</a></div>
    <div class="banner"><p>Winter tyres at the garage</p></div><div class="disclaimer"><p>No warranty for times</p></div></body></html>""",
)
