"""Clicks against the driver-side state machine, carried values, and fetching from a server that misbehaves."""

import http.server
import io
import json
import random
import threading
import zipfile

import pytest

from terracover.functions.colors import palette_for
from terracover.operators.numbering import carried
from terracover.operators.replay import replay
from terracover.scope import Selection, View
from terracover.sources import fetch as X

BRANDS = {"Banco": ["Itaú", "Caixa"], "Coop": ["Sicoob", "Ailos", "Cresol"]}
COLOURS = {"Itaú": "#ec7000", "Sicoob": "#003641"}


def test_replay_equals_the_state_machine(spark):
    r = random.Random(7)
    rows = []
    for k in range(2500):
        kind = r.choice(["region", "state", "brand", "category", "other", None])
        value = {"region": ["Sul", "Norte", None, "Nowhere"], "state": ["RS", "SP", None, "XX"], "brand": ["Itaú", "Sicoob", "Ailos", "Cresol", "Caixa", "None"], "category": ["Banco", "Coop"]}.get(kind, ["x"])
        rows.append((k, r.choice(["hot", "hot", "hot", "a", None]), kind, r.choice(value), r.choice([True, False, None])))
    df = spark.createDataFrame(rows, "id int, user string, kind string, value string, on boolean").repartition(6)
    got = {x["id"]: x for x in replay(df, BRANDS, COLOURS, "user", ["id"]).collect()}
    states: dict = {}
    for k, user, kind, value, on in rows:
        view, own = states.get(user, (View(), Selection.all(BRANDS)))
        on = True if on is None else on
        if kind == "region" and value in (None, "Sul", "Norte"):
            view = view.choose_region(value)
        elif kind == "state" and value in (None, "RS", "SP"):
            view = view.choose_state(value)
        elif kind == "brand" and value != "None":
            own = own.set_brand(value, on)
        elif kind == "category":
            own = own.set_category(value, on)
        states[user] = view, own
        x = got[k]
        assert (x.regiao, x.estado, x.rotulo_escopo, x.ativas, x.rotulo_selecao) == (view.region, view.state, view.label, own.active, own.label)
        assert x.rampa == palette_for(own.active, COLOURS)


def test_carried(spark):
    r = random.Random(1)
    rows = [(k, r.choice(["a", None]), r.choice([None, None, 1, 2]), r.choice([None, None, None, "x"])) for k in range(800)]
    got = {x["k"]: (x["n"], x["s"]) for x in carried(spark.createDataFrame(rows, "k int, g string, n int, s string").repartition(5), ["k"], ["g"], ["n", "s"]).collect()}
    last: dict = {}
    for k, g, n, s in rows:
        before = last.get(g, (None, None))
        last[g] = (before[0] if n is None else n, before[1] if s is None else s)
        assert got[k] == last[g]


@pytest.fixture
def server():
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("a.csv", "x" * 2000)
    features = json.dumps({"type": "FeatureCollection", "features": [{}]}).encode()
    calls: dict[str, int] = {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = calls[self.path] = calls.get(self.path, 0) + 1
            busy = {"/busy.zip": (429, 2), "/broken.zip": (500, 1), "/down.zip": (503, 99), "/absent.zip": (404, 99)}.get(self.path)
            body = {"/features.json": features, "/list.json": b"[]", "/none.json": b'{"type":"FeatureCollection","features":[]}', "/text.zip": b"no archive", "/empty.zip": b"", "/damaged.zip": packed.getvalue()[:60] + b"y" + packed.getvalue()[61:]}.get(self.path, packed.getvalue())
            if busy and n <= busy[1]:
                self.send_response(busy[0])
                self.end_headers()
                return
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body[: len(body) // 2] if self.path == "/cut.zip" and n < 3 else body)

        def log_message(self, *_):
            pass

    own = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}", calls
    own.shutdown()


def test_fetching(spark, tmp_path, server):
    address, calls = server
    want = {
        "good.zip": ("fetched", 1), "busy.zip": ("fetched", 3), "broken.zip": ("fetched", 2), "cut.zip": ("fetched", 3), "features.json": ("fetched", 1),
        "down.zip": ("failed", 4), "absent.zip": ("failed", 1), "text.zip": ("failed", 4), "empty.zip": ("failed", 4), "damaged.zip": ("failed", 4), "list.json": ("failed", 4), "none.json": ("failed", 4),
    }
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "good.zip").write_bytes(b"an old copy that is no archive")
    rows = [(f"{address}/{name}", f"{tmp_path}/d/{name}", "features" if name.endswith("json") else "zip") for name in want]
    requests = spark.createDataFrame(rows, "url string, target string, check string")
    out = X.fetch_all(requests, 4, wait=0.01)
    for _ in range(2):  # reading again fetches nothing
        got = {x["target"].rsplit("/", 1)[1]: (x["status"], x["tries"]) for x in out.collect()}
        assert got == want
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == sorted(k for k, v in want.items() if v[0] == "fetched")
    errors = {x["target"].rsplit("/", 1)[1]: x["error"] for x in out.where("status = 'failed'").collect()}
    assert "503" in errors["down.zip"] and "404" in errors["absent.zip"] and "no ZIP" in errors["text.zip"] and "empty" in errors["empty.zip"] and "features" in errors["list.json"]
    before = dict(calls)
    again = {x["status"] for x in X.fetch_all(requests.where("target LIKE '%good.zip' OR target LIKE '%features.json'"), 2).collect()}
    assert again == {"cached"} and calls == before
    assert X.fetch_all(requests.limit(0), 2).count() == 0
    gone = spark.createDataFrame([("http://127.0.0.1:1/x", f"{tmp_path}/x", None)], "url string, target string, check string")
    assert X.fetch_all(gone, 1, tries=2, wait=0.01).first().status == "failed"


def test_requests_of_states(spark, tmp_path, server):
    address, _ = server
    requests = X.state_requests(spark, ["RS", "SC"], address + "/{uf}/{code}.zip", f"{tmp_path}/s", ".zip", "zip")
    assert sorted(r["url"].removeprefix(address) for r in requests.collect()) == ["/RS/43.zip", "/SC/42.zip"]
    assert X.require_all(X.fetch_all(requests, 2, wait=0.01)) == [f"{tmp_path}/s/RS.zip", f"{tmp_path}/s/SC.zip"]
    with pytest.raises(OSError, match="404"):
        X.require_all(X.fetch_all(spark.createDataFrame([(f"{address}/absent.zip", f"{tmp_path}/s/x.zip", "zip")], "url string, target string, check string"), 1, wait=0.01))
