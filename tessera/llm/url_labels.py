"""URLs with a label, from which the URL filter learns when it is given none.

Written by hand for the kinds of addresses a crawl meets, on reserved example
domains: 1 for what a filter should block (betting, medicine and loan shops, adult
pages, advert and click counters, link farms, throw-away hosts), 0 for ordinary
pages (news, blogs, shops, encyclopedias, forums, documentation).
"""

LABELLED = """
0 https://www.example.com/
0 https://example.org/about
0 http://news.example.net/2021/03/14/council-votes-on-new-bridge.html
0 https://blog.example.com/en/how-we-moved-the-archive
0 https://www.daily.example.org/world/article/48213
0 https://herald.example.com/politics/2019/election-results?page=2
0 https://m.herald.example.com/sport/12873
0 https://www.tribune.example.net/de/wirtschaft/artikel-99321.html
0 http://lejournal.example.com/fr/culture/5521
0 https://eldiario.example.org/es/deportes/2201.html
0 https://wiki.example.org/wiki/History_of_printing
0 https://en.wiki.example.org/wiki/Nitrogen?action=history
0 http://docs.example.net/guide/install/linux.html
0 https://docs.example.com/v2/reference/tables#columns
0 https://forum.example.org/thread/88121?page=3
0 http://forum.gardeners.example.net/viewtopic.php?t=4412
0 https://recipes.example.com/soup/onion-soup
0 https://www.cooking.example.net/en/1187
0 http://kitchen.example.org/fr/912.html
0 https://shop.example.com/shoes/running?color=blue
0 https://www.bookstore.example.com/item/9780000000002
0 https://library.example.org/catalogue/record/771288
0 http://museum.example.net/exhibitions/2022/
0 https://www.university.example.org/faculty/physics/people/
0 https://physics.university.example.org/courses/ph101/notes.html
0 https://school.example.net/calendar
0 http://blog.teachers.example.com/es/318
0 https://weather.example.com/forecast/lyon
0 https://m.weather.example.net/de/berlin
0 https://travel.example.org/guides/portugal/lisbon/
0 http://www.hiking.example.com/trails/1442#map
0 https://maps.example.net/place/station
0 https://jobs.example.com/listing/39921?ref=home
0 https://www.cityhall.example.org/services/parking/permit
0 http://council.example.net/minutes/2018-11-05.html
0 https://health.example.org/conditions/asthma
0 https://clinic.example.com/doctors/
0 https://garden.example.net/en/roses/pruning
0 https://photos.example.com/album/55121
0 http://music.example.org/artist/1207/concerts
0 https://films.example.net/fr/critiques/871.html
0 https://www.chess.example.com/openings/sicilian
0 https://runner.example.org/de/773?utm_source=feed
0 http://blog.runner.example.com/en/88231/
0 https://painter.example.net/gallery#top
0 https://www.carpenter.example.com/es/4420?page=2&ref=x
0 https://sailor.example.org/en/51877.html
0 http://baker.example.com/de/60213
0 https://m.farmer.example.net/fr/3319?utm_source=feed
0 https://www.weaver.example.org/en/17?page=4
0 https://potter.example.net/en/90122#comments
0 http://tanner.example.com/fr/73
0 https://blog.mason.example.net/es/40217/
0 https://cooper.example.org/en/25.html
0 https://fletcher.example.com/de/8291?page=2&ref=x
0 https://smith.example.net/es/17640#top
0 http://m.thatcher.example.com/en/61320
0 https://www.brewer.example.org/fr/295?utm_source=feed
0 https://glover.example.net/en/90331.html
0 http://blog.chandler.example.com/de/471#top
0 https://www.city-library.example.org/opening-hours
0 https://night-sky.example.net/en/constellations
0 https://old-maps.example.com/1870/
0 http://code.example.com/project/parser/issues/221
0 https://git.example.org/tools/formatter/tree/main/src
0 https://packages.example.net/p/arrow/1.4.2/
0 https://research.example.org/abs/2104.01234
0 http://archive.example.net/details/voyage1897
0 https://podcasts.example.com/show/201/episode/17
0 https://radio.example.org/programme/morning?date=2020-05-01
0 https://bank.example.com/help/cards
0 https://insurance.example.net/claims/
0 https://www.zoo.example.org/animals/otter
0 http://trains.example.com/timetable?from=oslo&to=bergen
0 https://hotel.example.net/rooms
0 https://players.example.org/fr/13977
1 http://www.best-casino-bonus.example.com/free-spins?aff=8812
1 https://casino777.example.net/slots/play?ref=a1&cid=77812
1 http://online-casino.example.org/en/1289
1 https://win-big-slots.example.com/?click=99a8f1&src=mail
1 http://m.poker-king.example.net/de/221
1 https://free-poker-chips.example.com/claim
1 http://sports-betting24.example.org/odds?aff=22
1 https://www.bet-now.example.net/es/818.html
1 http://lucky-jackpot.example.com/fr/62
1 https://blog.roulette-tips.example.org/en/5512?utm_source=feed
1 http://buy-cheap-meds.example.com/viagra-100mg
1 https://www.discount-pharmacy-online.example.net/order?pid=100&aff=77
1 http://pills4you.example.org/no-prescription
1 https://diet-pills-now.example.com/en/3312
1 http://m.weight-loss-fast.example.net/de/9128#top
1 https://www.generic-meds.example.org/es/17.html
1 http://hot-singles-nearby.example.com/join?aff=123&sub=9
1 https://adult-cams.example.net/live
1 http://www.xxx-videos.example.com/fr/8821
1 https://sexy-chat.example.org/en/31?page=2&ref=x
1 http://blog.escort-girls.example.net/de/712
1 https://adult-tube-free.example.com/watch?v=8812&ad=1
1 http://ads.example.net/serve?z=12&cb=7781231&u=a81f&w=300&h=250
1 https://track.ads-server.example.com/click?cid=9981&aff=2&sub=41&t=162
1 http://banner-exchange.example.org/rotate?id=8812
1 https://pixel.web-counter.example.net/i.gif?r=0.8812371&u=41
1 http://m.click-tracker.example.com/en/2217
1 https://www.pop-under.example.org/go?z=4412&k=ab12
1 http://ad-network.example.net/fr/44127.html
1 https://redirect.traffic-exchange.example.com/out?u=aHR0cDovL2E&k=9921
1 http://link-farm.example.org/page8812.html
1 https://www.seo-links.example.com/directory/1/2/3/4/5
1 http://free-backlinks.example.net/es/190
1 https://blog.article-spinner.example.org/en/77182
1 http://cheap-traffic.example.com/buy
1 https://spam-links.example.net/de/31882#top
1 http://auto-blog-network.example.org/fr/120?utm_source=feed
1 https://quick-cash-loans.example.com/apply?aff=91&src=sms
1 http://payday-loan24.example.net/
1 https://www.credit-repair-now.example.org/en/99.html
1 http://bad-credit.example.com/de/4420
1 https://make-money-fast.example.net/secret
1 http://work-from-home.example.org/es/661?page=2&ref=x
1 https://crypto-double.example.com/send?wallet=1a2b3c
1 http://m.free-iphone.example.net/win
1 https://claim-your-prize.example.org/en/1?uid=81231231
1 http://replica-watches.example.com/fr/2281
1 https://www.fake-bags.example.net/shop?cat=7&aff=12
1 http://essay-writers.example.org/order-now
1 https://download-crack.example.com/serial/keygen.exe
1 http://free-movies-hd.example.net/watch/8812.html
1 https://torrent-files.example.org/de/50211
1 http://x7f3k9q2.example.com/a
1 https://a1b2c3d4e5.example.net/x?k=8812a7f1c2
1 http://192.0.2.17/login.php?user=1
1 https://198.51.100.4/wp-content/update/
1 http://secure-login-verify.account.update.example.org/signin?session=77a81f
1 https://secure-payments.example.com/confirm
1 http://your-bank.verify-id.example.net/en/step1
1 https://www.free-gift-cards.example.org/de/117
1 http://sms-alerts.example.com/unsubscribe?m=81231&k=7
1 https://lottery-win.example.net/es/3012
1 http://blog.hair-growth.example.org/en/80123/
1 https://miracle-cure.example.com/fr/771#top
1 http://cam-girls.example.net/en/12
"""
