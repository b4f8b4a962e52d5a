"""First-order trainers on the factorisation loss: fixed step (M4), adaptive
step (M5), descent with line search (M6) and Polak–Ribière conjugate
gradients (M7).

The ratings of a problem are laid out once (``RatingBlocks``).  Along a direction the loss is an exact quartic in the
step (A11), so a line search has no trial evaluations: the best step is a root of the
quartic's derivative, a cubic solved on the driver.  The trainers with a line (M5, M6, M7) take one job a step
(``operators.lines``): it writes point, direction and the gradient's coefficients along the line, and observes the loss along it
and the inner products that the next direction needs.  With fixed steps (M4) a job takes several steps
(``operators.steps``); the driver gets the loss at every point, and those after the one that meets the stop test are
thrown away.  The driver holds scalars only.  A table is deleted when the next one is written.

All trainers run to their own stop test; ``max_iter`` (default None) is a
caller's bound, and ``Fit.converged`` tells whether the test was met.  A loss
that is no longer finite, or a step that no longer moves the point, ends a run
that would otherwise go on for ever (Q16), unconverged.

The trace (``history``) has one row per accepted point:
``(iter, loss, red, step)``; ``loss`` is the true loss there, ``red`` = loss /
previous loss.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import lines, steps
from ..operators import objective as ob
from ..operators.blocks import RatingBlocks, dot_sql, gradient_state, loss_pass, number, poly_pass
from ..operators.params import Params
from ..session import cut, drop_cut


def combine(ca: float, a: str, cb: float, b: str) -> str:
    """V2 over two vector columns: ``ca·a + cb·b``, as SQL."""
    return f"zip_with({a}, {b}, (p, q) -> {number(ca)} * p + {number(cb)} * q)"


def scaled(c: float, a: str) -> str:
    """V4 over a vector column, as SQL."""
    return f"transform({a}, p -> {number(c)} * p)"


@dataclass
class Point:
    """A written table ``side, id, x, g`` (and what is carried), with what was observed while it was written: ``loss``, the
    squared gradient norm ``gg``, and the products of the new gradient with the carried columns."""
    table: DataFrame
    loss: float
    gg: float
    products: dict[str, float] = field(default_factory=dict)

    def params(self) -> Params:
        """The vectors; ``Params.drop`` deletes the table."""
        x = self.table.filter("side >= 0").select("side", "id", F.col("x").alias("features"))
        x.written_at = getattr(self.table, "written_at", None)
        return Params.of_table(x)

    def rows(self) -> DataFrame:
        return self.table.filter("side >= 0")

    def drop(self) -> None:
        drop_cut(self.table)


@dataclass
class Problem:
    ratings: DataFrame
    k: int
    lam: float
    normalizer: float
    blocks: RatingBlocks | None = None
    shared: bool = False    # ``blocks`` serve several problems over the same ratings: whoever made them releases them

    def layout(self) -> RatingBlocks:
        if self.blocks is None:
            # a line sends twice as many numbers with an id as other passes, so half the ratings to a block
            self.blocks = RatingBlocks.of(self.ratings, per_block=1_000_000, sides=("grid",))
        return self.blocks

    def release(self) -> None:
        if self.blocks is not None and not self.shared:
            self.blocks.release()
            self.blocks = None

    def at(self, point: DataFrame, carried: tuple[str, ...] = ()) -> Point:
        """Gradient, loss and inner products at ``point(side, id, blocks, x, carried…)``, from one job that writes the table."""
        state = gradient_state(self.layout(), point.select("side", "id", "blocks", "x", *carried), self.k, self.lam, self.normalizer)
        seen = Observation()
        table = cut(state.observe(seen, F.expr("max(if(side < 0, g[0], null)) loss"), *[
            F.expr(f"sum(if(side >= 0, {dot_sql(c, 'g', self.k)}, null)) {name}") for c, name in (("g", "gg"), *zip(carried, carried))]))
        found = {name: float("nan") if v is None else float(v) for name, v in seen.get.items()}
        return Point(table, found.pop("loss"), found.pop("gg"), found)

    def start(self, x: Params) -> Point:
        # the blocks that need a vector go with it from point to point
        blocks = self.layout()
        return self.at(blocks.routed(blocks.both, x.table().select("side", "id", F.col("features").alias("x"))))

    def move(self, p: Point, step: str) -> Point:
        """The point with vectors ``step`` (SQL over ``p``'s columns); ``p``'s table goes."""
        new = self.at(p.rows().selectExpr("side", "id", "blocks", f"{step} x"))
        p.drop()
        return new

    def walk(self, x: Params, a: float) -> steps.Walk:
        """Descent by fixed steps ``a`` from ``x``, many of them to a job."""
        return steps.Walk(self.layout(), x.table(), self.k, self.lam, self.normalizer, a)

    def line(self, x: Params) -> lines.Line:
        """Loss and gradient at ``x``, a line of no direction."""
        return lines.start(self.layout(), x.table(), self.k, self.lam, self.normalizer)

    def along(self, line: lines.Line, z: float, beta: float = 0.0) -> lines.Line:
        """The line in the direction ``beta s - g`` from the point after the step ``z`` along ``line``; ``line``'s table goes."""
        new = lines.along(self.layout(), line, z, beta, self.k, self.lam, self.normalizer)
        line.drop()
        return new

    @staticmethod
    def end(line: lines.Line, z: float) -> Params:
        """The vectors after the step ``z``; ``line``'s table goes."""
        x = line.params(z)
        line.drop()
        return Params.of_table(x)

    def loss(self, x: Params) -> float:
        return float(loss_pass(self.layout(), x.table(), self.k, self.lam, self.normalizer).first()["loss"])

    def poly(self, p: Point, d: str) -> tuple[float, ...]:
        """Coefficients of a ↦ loss(x − a·d), ``d`` SQL over the point's columns."""
        row = poly_pass(self.layout(), p.rows().selectExpr("side", "id", "blocks", "x", f"{d} d"), self.k, self.lam, self.normalizer).first()
        return tuple(float(row[f"c{j}"]) for j in range(5))


@dataclass
class Trace:
    rows: list = field(default_factory=list)

    def add(self, it: int, loss: float, red: float, step: float | None):
        self.rows.append({"iter": int(it), "loss": float(loss), "red": float(red),
                          "step": None if step is None else float(step)})

    @property
    def head(self):
        return self.rows[-1]

    def shrink(self, n: int = 10) -> float:
        """W1 on the driver-side trace: 1 − mean(red) over the latest n rows."""
        last = self.rows[-n:]
        return 1.0 - sum(r["red"] for r in last) / len(last)

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, "iter int, loss double, red double, step double")


@dataclass
class Fit:
    params: Params
    trace: Trace
    converged: bool = False


def turns(max_iter: int | None):
    return count() if max_iter is None else range(max_iter)


def fit_gd_fixed(prob: Problem, x: Params, a: float, eps: float, max_iter: int | None = None) -> Fit:
    """M4: x ← x − a·∇f(x) until |Δloss| ≤ ε.  First row has red 0.5; the
    step that triggers the stop is taken but not recorded (as in the
    reference)."""
    tr, done, end, walk = Trace(), False, None, None
    try:
        walk = prob.walk(x, a)
        while end is None:
            base = walk.done
            passes = min(steps.MOST, max(steps.FIRST, base))
            for t, loss in enumerate(walk.go(passes if max_iter is None else min(passes, max_iter + 1 - base)), base):
                if t == 0:
                    continue
                if not math.isfinite(loss):
                    end = t
                elif not tr.rows:
                    tr.add(0, loss, 0.5, a)
                elif abs(tr.head["loss"] - loss) > eps:
                    tr.add(tr.head["iter"] + 1, loss, loss / tr.head["loss"], a)
                else:
                    end, done = t, True
                if end is not None:
                    break
            if end is None and max_iter is not None and walk.done > max_iter:
                end = max_iter
        return Fit(Params.of_table(walk.point(end)), tr, done)
    finally:
        if walk is not None:
            walk.release()
        prob.release()


def fit_gd_adaptive(prob: Problem, x: Params, a: float, eps: float, max_iter: int | None = None,
                    grow: float = 1.1, shrink_by: float = 0.8, window: int = 10) -> Fit:
    """M5: try x − a·∇f; accept (a×1.1) if the loss falls, else a×0.8; stop
    when the shrink rate over the last ``window`` rows drops below ε.
    Rejected trials are polynomial values: no Spark job."""
    tr, first, done, c, z = Trace(), a, False, None, 0.0
    try:
        line = prob.line(x)
        tr.add(0, line.loss, 0.5, None)
        for _ in turns(max_iter):
            if tr.shrink(window) < eps:
                done = True
                break
            if c is None:
                line = prob.along(line, z)
                c, z = line.c, 0.0
            y = ob.poly_eval(c, a)
            if y < c[0]:
                z, before, c = a, c[0], None
                tr.add(tr.head["iter"] + 1, y, y / before if before else 0.0, a)
                a *= grow
            else:
                a *= shrink_by
                if not a > first * 1e-15:
                    break
        end = prob.end(line, z)
    finally:
        prob.release()
    return Fit(end, tr, done)


def stationary_steps(c) -> list[float]:
    """Positive steps at which the slope of the loss polynomial is zero, ascending."""
    slope = [4 * c[4], 3 * c[3], 2 * c[2], c[1]]
    if not all(map(math.isfinite, slope)) or not any(slope):
        return []
    roots = np.roots(slope)
    real = roots.real[np.abs(roots.imag) <= 1e-7 * np.abs(roots)]
    return sorted(float(z) for z in real if z > 0 and math.isfinite(z))


def exact_step(c) -> tuple[float, float]:
    """The step with the least loss along the line, and that loss; (0, loss here) if no step is better."""
    best = min(((ob.poly_eval(c, z), z) for z in stationary_steps(c)), default=(c[0], 0.0))
    return (best[1], best[0]) if best[0] < c[0] else (0.0, c[0])


def fit_gd_linesearch(prob: Problem, x: Params, eps: float = 0.001, adjust: int = 10,
                      max_iter: int | None = None, window: int = 10, grow: float = 1.5) -> Fit:
    """M6 (the reference's trainer 1): descent whose step comes from a line
    search at the start and whenever a step would not improve, and grows by
    ``grow`` after ``adjust`` improving steps in a row.  Stops when the shrink
    rate is below ε after an improving step.  The search takes the exact
    minimiser of the line, so it needs no starting step; every move has its row
    in the trace (Q17)."""
    tr, done = Trace(), False
    a, left, z = None, adjust, 0.0
    try:
        line = prob.line(x)
        for _ in turns(max_iter):
            line = prob.along(line, z)
            c, z = line.c, 0.0
            shrink = tr.shrink(window) if tr.rows else math.inf
            kept = a is not None and ob.poly_eval(c, a) < c[0]
            if not kept:
                a, left = exact_step(c)[0], adjust
                if not a:  # a stationary point
                    done = math.isfinite(line.loss)
                    break
            z, y = a, ob.poly_eval(c, a)
            tr.add(len(tr.rows), y, y / c[0] if c[0] else 0.0, a)
            if kept:
                if shrink < eps:
                    done = True
                    break
                left -= 1
                if not left:
                    a, left = a * grow, adjust
        end = prob.end(line, z)
    finally:
        prob.release()
    return Fit(end, tr, done)


# Constants of the strong Wolfe conditions, and the default number of line searches.
WOLFE_DECREASE = 0.01
WOLFE_CURVATURE = 0.5
CG_LENGTH = 100


def wolfe_step(c) -> float | None:
    """The first stationary step along the line that meets the strong Wolfe conditions, or None.

    At a root of the slope the curvature condition holds up to rounding, so
    what is left to test is sufficient decrease.
    """
    for z in stationary_steps(c):
        enough = ob.poly_eval(c, z) <= c[0] + WOLFE_DECREASE * z * c[1]
        if enough and abs(ob.poly_slope(c, z)) <= WOLFE_CURVATURE * abs(c[1]):
            return z
    return None


def fit_cg(prob: Problem, x: Params, length: int | None = CG_LENGTH, eps: float = 0.0) -> Fit:
    """M7: Polak–Ribière conjugate gradients, at most ``length`` line searches.

    The direction is −∇f + β·(previous direction) with
    β = max(0, g₁·(g₁ − g₀) / g₀·g₀), and −∇f again whenever that would not
    descend or its line has no acceptable step; if −∇f has none either, the
    best point so far is returned (Q15).  ``converged``: the gradient vanished,
    or a step from −∇f changed the loss by at most ``eps`` times the loss.
    """
    tr, done = Trace(), False
    try:
        line = prob.line(x)
        tr.add(0, line.loss, 1.0, None)
        # the point is ``line`` after the step z; the direction from it is beta·s − g, with s the direction before (none while plain)
        z, beta, plain = 0.0, 0.0, True
        for _ in turns(length):
            line, z = prob.along(line, z, beta), 0.0
            if not line.gg > 0:
                done = math.isfinite(line.loss)
                break
            step = wolfe_step(line.c) if line.c[1] < 0 else None
            if step is None:
                if plain:
                    done = math.isfinite(line.loss)
                    break
                beta, plain = 0.0, True
                continue
            z, y = step, ob.poly_eval(line.c, step)
            tr.add(tr.head["iter"] + 1, y, y / line.loss if line.loss else 0.0, z)
            small = line.loss - y <= eps * abs(line.loss)
            if plain and small:
                done = True
                break
            # too little along the old directions: from −∇f again
            beta = 0.0 if small else max(0.0, line.change(z) / line.gg)
            plain = beta == 0.0
        end = prob.end(line, z)
    finally:
        prob.release()
    return Fit(end, tr, done)
