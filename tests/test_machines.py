"""Per-key stream state machines in plain Python: outputs, deadlines, and that
state is released once it can no longer affect any output."""

from tidemark.streaming.processors import (
    ClickLimitMachine,
    LoginBurstMachine,
    LoginPairMachine,
    OrderPayMachine,
    OrderTimeoutMachine,
    TxMatchMachine,
)

S = 1_000_000


def run(m, key, events, wm):
    st = m.initial()
    out = []
    for ev in events:
        out += m.step(key, st, ev)
    flushed, deadline = m.flush(key, st, wm)
    return out + flushed, deadline, st


def test_login_pair_forgets_after_gap():
    m = LoginPairMachine(gap_s=2)
    out, deadline, st = run(m, 7, [(0, 0, 1, "fail"), (S, 0, 2, "fail")], wm=2 * S)
    assert out == [(7, 0, 1000, "重复登录失败")] and deadline == 3 * S and not m.idle(st)
    out, deadline, st = run(m, 7, [(0, 0, 1, "fail")], wm=5 * S)
    assert out == [] and m.idle(st)


def test_order_pay_releases_after_limit():
    m = OrderPayMachine(limit_s=10)
    out, deadline, st = run(m, 1, [(0, 0, 1, "create")], wm=5 * S)
    assert out == [] and deadline == 10 * S
    out, _, st = run(m, 1, [(0, 0, 1, "create")], wm=11 * S)
    assert out == [(1, 0, None, "create but not payed")] and m.idle(st)


def test_click_limit_resets_at_local_midnight():
    m = ClickLimitMachine(max_clicks=1, day_offset_s=0)
    events = [(i * S, 0, i, "click", None, "p") for i in range(3)]
    out, deadline, st = run(m, (5, 9), events, wm=3 * S)
    assert [o[2] for o in out] == ["pass", "warning"] and deadline == 86_400 * S
    _, _, st = run(m, (5, 9), events, wm=86_400 * S)
    assert m.idle(st)


def test_burst_releases_when_its_run_ends():
    m = LoginBurstMachine(2, 2)
    st = m.initial()
    assert m.idle(st)
    m.step(1, st, (0, 0, 1, "fail"))
    m.step(1, st, (S, 0, 2, "fail"))
    out, _ = m.flush(1, st, 5 * S)
    assert out == [(1, 0, 1000, 2, "失败2次")] and not m.idle(st)   # the run goes on, without a second alert
    m.step(1, st, (6 * S, 0, 3, "success"))
    assert m.idle(st)


def test_order_timeout_with_many_waiting_creates_is_linear():
    import time
    m = OrderTimeoutMachine(1e9)
    st = m.initial()
    t0 = time.perf_counter()
    for i in range(50_000):
        m.step(1, st, (i, 0, i, "create"))
    out = m.step(1, st, (60_000, 1, 7, "pay"))
    assert len(out) == 50_000 and m.idle(st) and time.perf_counter() - t0 < 5


def test_tx_match_slot():
    m = TxMatchMachine(wait_s=1)
    st = m.initial()
    out = m.step(3, st, (0, 0, 1, "pay", None, "p1")) + m.step(3, st, (S // 2, 0, 2, "pay", None, "p2"))
    assert out == [(3, "order_only", 1, None, 0, None, "p1", None)] and not m.idle(st)
    out = m.step(3, st, (S, 1, 3, "receipt", None, "r3"))
    assert out == [(3, "matched", 2, 3, 500, 1000, "p2", "r3")] and m.idle(st)
    m.step(3, st, (2 * S, 0, 4, "pay", None, "p4"))
    assert m.flush(3, st, 3 * S) == ([], 3 * S)
    assert m.flush(3, st, 3 * S + 1)[0] == [(3, "order_only", 4, None, 2000, None, "p4", None)] and m.idle(st)
    assert m.step(None, st, (0, 0, 5, "pay", None, "p5")) == [(None, "order_only", 5, None, 0, None, "p5", None)]
    assert m.idle(st)
