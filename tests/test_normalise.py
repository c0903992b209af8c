"""Raw JSON post -> record: defaults, language filter, quarantine."""

import json

from postscope.functions.json import normalise, quarantined, valid_posts
from postscope.sources.posts import live_posts

GOOD = {
    "created_at": "Wed Mar 04 08:09:10 +0000 2020", "id": 2305843009213693953,
    "text": "RT @y: Apple and Intel today", "lang": "en",
    "user": {"name": "ann", "followers_count": 41, "favourites_count": 7,
             "statuses_count": 1234, "lang": None},
    "retweet_count": 0,
    "retweeted_status": {"created_at": "Wed Mar 04 07:00:00 +0000 2020", "id": 2305843009213690001,
                         "text": "Apple and Intel today", "retweet_count": 12,
                         "user": {"name": "ben", "followers_count": 999,
                                  "favourites_count": 3, "statuses_count": 88}},
}


def rows(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_good_post_fields(spark):
    p = valid_posts(normalise(rows(spark, [json.dumps(GOOD)]), tags=["Google", "Apple", "Intel"])).first()
    assert p.id == 2305843009213693953            # above 2^53, kept exact
    assert p.tag == "Apple"                        # Apple x2, Intel x2: earlier wins
    assert p.username == "ann" and p.followersCount == 41
    assert p.statusesCount == 1234 and p.favouritesCount == 7
    assert p.createdAt == 1583309350000
    assert p.timestamp == "March 04 2020, 08:09:10.000"
    assert p.retweet.retweetCount == 12 and p.retweet.followersCount == 999
    assert p.retweet.statusesCount == 88 and p.retweet.favouritesCount == 3
    assert p.isEnglish is True


def test_defaults_and_coercion(spark):
    d = dict(GOOD)
    d.pop("retweeted_status")
    d["retweet_count"] = "12"        # numeric string coerces
    d["user"] = {"name": None, "followers_count": "abc"}
    p = valid_posts(normalise(rows(spark, [json.dumps(d)]))).first()
    assert p.retweetCount == 12
    assert p.username == "" and p.followersCount == 0 and p.statusesCount == 0
    assert p.retweet.id == 0 and p.retweet.retweetCount == 0


def test_language_filter(spark):
    no_lang = {k: v for k, v in GOOD.items() if k != "lang"}
    fr = dict(GOOD, lang="fr")
    only_user = dict(no_lang, user=dict(GOOD["user"], lang="en"))
    n = normalise(rows(spark, [json.dumps(no_lang), json.dumps(fr), json.dumps(only_user),
                               json.dumps({"delete": {"status": {"id": 1}}})]))
    assert n.count() == 0


def test_quarantine(spark):
    bad_date = dict(GOOD, created_at="")
    no_user = {k: v for k, v in GOOD.items() if k != "user"}
    n = normalise(rows(spark, ["{not json", json.dumps(bad_date), json.dumps(no_user), json.dumps(GOOD)]))
    q = sorted(r.error for r in quarantined(n).collect())
    assert q == ["bad created_at", "malformed json", "no user object"]
    assert valid_posts(n).count() == 1


def test_live_posts_stream(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "a.json").write_text(json.dumps(GOOD) + "\n" + "{broken\n")
    from postscope.sources.posts import live_raw
    s = live_posts(live_raw(spark, str(land)), tags=["Apple"], track=["apple"])
    q = (s.writeStream.format("memory").queryName("live_posts_t").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select id, tag, t from live_posts_t").collect()
    assert len(got) == 1 and got[0].tag == "Apple" and got[0].t is not None


def test_decimal_and_far_counts(spark):
    def counts(value):
        line = json.dumps(dict(GOOD, user={"name": "x", "followers_count": 1})).replace('"followers_count": 1', f'"followers_count": {value}')
        return valid_posts(normalise(rows(spark, [line]))).first().followersCount
    assert [counts(v) for v in ("12.7", '"12.7"', "1000.0", "1e3", "3e9", "-5.9", "true", '"NaN"')] == [12, 12, 1000, 1000, 2 ** 31 - 1, -5, 0, 0]


def test_lenient_dates(spark):
    from postscope.functions.time import parse_created_at
    texts = ["Tue Oct 2 00:00:00 +0000 2019", "Tue Oct 02 00:00:00 +0000 2019", "Tue Oct 32 00:00:00 +0000 2019", "Tue Nov 1 00:00:00 +0000 2019",
             "Tue oct 01 25:00:00 +0000 2019", "Tue Oct 02 01:00:00 +0000 2019", "Tue Oct 01 00:00:00 +0130 2019", "never", "", None, "Tue Foo 01 00:00:00 +0000 2019"]
    got = [r.ms for r in spark.createDataFrame([(x,) for x in texts], "s string").select(parse_created_at("s").alias("ms")).collect()]
    assert got[0] == got[1] == 1569974400000 and got[2] == got[3] and got[4] == got[5] and got[6] == 1569888000000 - 5400000
    assert got[7:] == [None] * 4


def test_language_decides_before_a_misplaced_user(spark):
    odd = dict(GOOD, user="nobody")
    n = normalise(rows(spark, [json.dumps(dict(odd, lang="fr")), json.dumps(odd), "[1, 2]", "7"]))
    assert sorted(r.error for r in quarantined(n).collect()) == ["malformed json", "malformed json", "no user object"]


def test_counts_beyond_int_saturate(spark):
    from postscope.sources.tables import event_posts
    e = spark.sql("SELECT 1L AS event_id, timestamp'2020-01-01' AS ts, 'a' AS event_type, 5000000000L AS user_id, 3e9D AS value, '{\"k\":1}' AS props")
    p = event_posts(e).first()
    assert p.followersCount == p.statusesCount == 2 ** 31 - 1
