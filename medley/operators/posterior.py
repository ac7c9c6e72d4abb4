"""Posterior of a sample's composition: MAP, variational and Hamiltonian fits, one sample per group.

Model: theta ~ Dirichlet(alpha); an optional gate z_g, a relaxed Bernoulli in logit space, switches genomes
off and theta_eff is z * theta made to sum to one; reads follow theta_eff T M' with M' = (1 - s) I + s M, clamped
at zero with rows made to sum to one, and s ~ LogNormal(0, 0.3); counts are Dirichlet-multinomial with concentration kappa * N, kappa ~ LogNormal(1.1, 1), or
multinomial. Spark brings each sample's counts together and fits samples in parallel; the matrices are as small as the
references and travel with the function.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import written
from .composition import posterior_summary

S_SCALE, K_MEAN, K_SCALE = 0.3, 1.1, 1.0


@dataclass(frozen=True)
class InferenceOptions:
    mode: str = "vi"
    alpha: float = 0.5
    steps: int = 3000
    lr: float = 0.02
    num_samples: int = 500
    warmup: int = 500
    presence: bool = True
    presence_prior: float = 0.01
    presence_temp: float = 1.0
    use_mismapping: bool = True
    likelihood: str = "dirichlet_multinomial"
    seed: int = 42

    def __post_init__(self):
        if self.mode not in ("vi", "mle", "nuts"):
            raise ValueError(f"unknown mode {self.mode}")
        if self.mode == "nuts" and self.presence:
            raise ValueError("nuts has no presence gate")
        if self.likelihood not in ("dirichlet_multinomial", "multinomial"):
            raise ValueError(f"unknown likelihood {self.likelihood}")
        positive = {n: getattr(self, n) for n in ("alpha", "steps", "lr", "num_samples", "presence_temp")}
        if bad := [n for n, v in positive.items() if not v > 0]:
            raise ValueError(f"{', '.join(bad)}: over zero")
        if not 0 < self.presence_prior < 1 or self.warmup < 0:
            raise ValueError("presence_prior lies between zero and one, warmup is not negative")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By recurrence up to 12, then Stirling's series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    while (small := x < 12).any():
        out[small] -= np.log(x[small])
        x[small] += 1
    y = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x


def digamma(x: np.ndarray) -> np.ndarray:
    """By recurrence up to 12, then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    while (small := x < 12).any():
        out[small] -= 1 / x[small]
        x[small] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


class Model:
    """Log density and gradient in u = (genome logits, log s, log kappa) and the gate's logits."""

    def __init__(self, t: np.ndarray, m: np.ndarray, y: np.ndarray, o: InferenceOptions):
        self.t, self.y, self.o = t, np.round(y), o
        self.m = m / m.sum(1, keepdims=True)
        self.n = self.y.sum()
        self.g = len(t)

    def confused(self, r: np.ndarray, s: float):
        """r times M' = (1 - s) I + s M, negative entries made zero and rows made to sum to one.

        Also two functions of a derivative by the result: its derivative by r, and by s. Only diagonal entries can be negative,
        where s is over 1 / (1 - m_ii); what the clamp adds there is what the row's sum exceeds one by.
        """
        if not self.o.use_mismapping:
            return r, lambda d: d, lambda d: 0.0
        diagonal = np.diag(self.m)
        over = np.maximum(s * (1 - diagonal) - 1, 0)
        clamped, q = over > 0, r / (1 + over)

        def by_r(d: np.ndarray) -> np.ndarray:
            return (s * (self.m @ d) + (1 - s + over) * d) / (1 + over)

        def by_s(d: np.ndarray) -> float:
            more = np.where(clamped, (1 - diagonal) * (d - by_r(d)), 0)
            return float(q @ (self.m @ d - d + more))

        return s * (q @ self.m) + (1 - s + over) * q, by_r, by_s

    def likelihood(self, theta: np.ndarray, z: np.ndarray, s: float, kappa: float):
        """Log likelihood and its derivatives by theta, z, s and kappa."""
        u = z * theta
        total = u.sum()
        e = u / total
        r, by_r, by_s = self.confused(e @ self.t, s)
        y, n = self.y, self.n
        if self.o.likelihood == "multinomial":
            safe = np.maximum(r, 1e-300)
            value, g_r, g_k = float((y * np.log(safe)).sum()), y / safe, 0.0
        else:
            c = kappa * n * r + 1e-6
            total_c = c.sum()
            value = lgamma(total_c) - lgamma(total_c + n) + float((log_gamma(c + y) - log_gamma(c)).sum())
            d = digamma(np.array([total_c]))[0] - digamma(np.array([total_c + n]))[0] + digamma(c + y) - digamma(c)
            g_r, g_k = kappa * n * d, float((d * n * r).sum())
        g_e = self.t @ by_r(g_r)
        g_u = (g_e - g_e @ e) / total
        return value, g_u * z, g_u * theta, by_s(g_r), g_k

    def joint(self, x: np.ndarray, z: np.ndarray | None = None, jacobian: bool = True):
        """Log joint and gradient at x; the gradient by z if a gate is given."""
        logits = x[: self.g] - x[: self.g].max()
        theta = np.maximum(np.exp(logits) / np.exp(logits).sum(), 1e-12)
        theta /= theta.sum()
        s, kappa = np.exp(x[-2]), np.exp(x[-1])
        value, d_theta, d_z, d_s, d_k = self.likelihood(theta, np.ones(self.g) if z is None else z, s, kappa)
        # Dirichlet prior; with the volume of the simplex map for full posteriors, and a weak pin on the free direction
        a = self.o.alpha if jacobian else self.o.alpha - 1
        value += a * np.log(theta).sum() - 0.5 * x[: self.g].mean() ** 2
        grad = np.zeros_like(x)
        d_theta = d_theta + a / theta
        grad[: self.g] = theta * (d_theta - d_theta @ theta) - x[: self.g].mean() / self.g
        # log s and log kappa are normal; without the volume the density is the log-normal's own
        for i, mean, scale, d, v in ((-2, 0.0, S_SCALE, d_s, s), (-1, K_MEAN, K_SCALE, d_k, kappa)):
            value += -0.5 * ((x[i] - mean) / scale) ** 2 - (0 if jacobian else x[i])
            grad[i] = d * v - (x[i] - mean) / scale**2 - (0 if jacobian else 1)
        return value, grad, d_z, theta

    def gate(self, logit_z: np.ndarray, location: np.ndarray | float):
        """Log density of a relaxed Bernoulli in logit space, and its derivatives by value and location."""
        t = self.o.presence_temp
        a = location - t * logit_z
        sig = 1 / (1 + np.exp(-a))
        return float((np.log(t) + a - 2 * np.logaddexp(0, a)).sum()), -t * (1 - 2 * sig), 1 - 2 * sig


class Adam:
    def __init__(self, size: int, lr: float):
        self.m, self.v, self.t, self.lr = np.zeros(size), np.zeros(size), 0, lr

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad * grad
        return self.lr * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _start(model: Model, theta0: np.ndarray) -> np.ndarray:
    logits = np.log(np.maximum(theta0, 1e-4))
    return np.concatenate([logits - logits.mean(), [0.0, np.log(3.0)]])


class Gate:
    """The variational gate: a relaxed Bernoulli per genome in logit space, drawn anew in each step."""

    def __init__(self, model: Model, o: InferenceOptions, rng: np.random.Generator):
        self.model, self.t, self.rng = model, o.presence_temp, rng
        self.prior = np.log(o.presence_prior / (1 - o.presence_prior))
        self.location = np.full(model.g, 2.0)

    def draw(self) -> np.ndarray:
        u = self.rng.uniform(1e-9, 1 - 1e-9, self.model.g)
        return (self.location + np.log(u) - np.log1p(-u)) / self.t

    def presence(self) -> np.ndarray:
        return 1 / (1 + np.exp(-self.location))

    def joint(self, x: np.ndarray, jacobian: bool):
        """One draw's log joint less the gate's own density, and the derivatives by x and by the gate's locations."""
        zl = self.draw()
        z = np.clip(1 / (1 + np.exp(-zl)), 1e-9, 1 - 1e-9)
        value, grad, d_z, _ = self.model.joint(x, z, jacobian)
        p, p_v, _ = self.model.gate(zl, self.prior)
        q, q_v, q_l = self.model.gate(zl, self.location)
        return value + p - q, grad, (d_z * z * (1 - z) + p_v - q_v) / self.t - q_l


def fit_map(model: Model, theta0: np.ndarray, o: InferenceOptions):
    """Point estimate: theta, presence, loss per step. The gate is drawn in each step, and applied as a hard one at the end."""
    x, gate = _start(model, theta0), Gate(model, o, np.random.default_rng(o.seed))
    adam, losses = Adam(len(x) + model.g, o.lr), []
    for _ in range(o.steps):
        if o.presence:
            value, grad, d_l = gate.joint(x, False)
        else:
            value, grad, _, _ = model.joint(x, None, jacobian=False)
            d_l = np.zeros(model.g)
        move = adam.step(np.concatenate([grad, d_l]))
        x, gate.location = x + move[: len(x)], np.clip(gate.location + move[len(x) :], -20, 20)
        losses.append(-value)
    _, _, _, theta = model.joint(x, None, jacobian=False)
    presence = gate.presence() if o.presence else np.ones(model.g)
    if o.presence:
        theta = theta * (presence >= 0.5) + 1e-12
    return (theta / theta.sum())[None, :], presence, losses


def fit_vi(model: Model, theta0: np.ndarray, o: InferenceOptions):
    """Mean-field normal with a relaxed-Bernoulli gate, by reparameterised gradients; draws of theta_eff."""
    rng = np.random.default_rng(o.seed)
    mu, gate = _start(model, theta0), Gate(model, o, rng)
    d = len(mu)
    rho = np.full(d, np.log(0.1))
    adam, losses = Adam(2 * d + model.g, o.lr), []
    for _ in range(o.steps):
        eps = rng.standard_normal(d)
        x = mu + np.exp(rho) * eps
        if o.presence:
            value, grad, d_l = gate.joint(x, True)
        else:
            value, grad, _, _ = model.joint(x)
            d_l = np.zeros(model.g)
        losses.append(-(value + rho.sum()))
        move = adam.step(np.concatenate([grad, grad * eps * np.exp(rho) + 1, d_l]))
        mu, rho, gate.location = mu + move[:d], np.clip(rho + move[d : 2 * d], -12, 2), np.clip(gate.location + move[2 * d :], -20, 20)
    draws = []
    for _ in range(o.num_samples):
        x = mu + np.exp(rho) * rng.standard_normal(d)
        theta = np.exp(x[: model.g] - x[: model.g].max())
        theta = theta / theta.sum() * (1 / (1 + np.exp(-gate.draw())) if o.presence else 1)
        draws.append(theta / theta.sum())
    return np.array(draws), gate.presence() if o.presence else np.ones(model.g), losses


def fit_nuts(model: Model, theta0: np.ndarray, o: InferenceOptions):
    """No-U-turn sampler with dual averaging of the step size."""
    rng = np.random.default_rng(o.seed)
    x = fit_map(model, theta0, InferenceOptions(mode="mle", presence=False, alpha=max(o.alpha, 1.0), steps=300, lr=0.05, likelihood=o.likelihood))[0][0]
    x = _start(model, x)
    f = lambda q: model.joint(q)[:2]

    def leap(q, p, g, e):
        p = p + 0.5 * e * g
        q = q + e * p
        v, g = f(q)
        return q, p + 0.5 * e * g, v, g

    def tree(q, p, g, log_u, way, depth, e, h0):
        if depth == 0:
            q1, p1, v1, g1 = leap(q, p, g, way * e)
            h = v1 - 0.5 * p1 @ p1
            ok = np.isfinite(h)
            return q1, p1, g1, q1, p1, g1, q1, int(ok and log_u <= h), ok and log_u < h + 1000, min(1.0, np.exp(min(0.0, h - h0))) if ok else 0.0, 1
        ql, pl, gl, qr, pr, gr, qn, n, go, a, k = tree(q, p, g, log_u, way, depth - 1, e, h0)
        if go:
            if way < 0:
                ql, pl, gl, _, _, _, q2, n2, go2, a2, k2 = tree(ql, pl, gl, log_u, way, depth - 1, e, h0)
            else:
                _, _, _, qr, pr, gr, q2, n2, go2, a2, k2 = tree(qr, pr, gr, log_u, way, depth - 1, e, h0)
            if n2 and rng.random() < n2 / max(1, n + n2):
                qn = q2
            go = go2 and (qr - ql) @ pl >= 0 and (qr - ql) @ pr >= 0
            n, a, k = n + n2, a + a2, k + k2
        return ql, pl, gl, qr, pr, gr, qn, n, go, a, k

    e, bar, hbar, anchor = 0.05, 0.05, 0.0, np.log(0.5)
    draws, losses = [], []
    v, g = f(x)
    for i in range(1, o.warmup + o.num_samples + 1):
        p = rng.standard_normal(len(x))
        h0 = v - 0.5 * p @ p
        log_u = h0 - rng.exponential()
        ql = qr = qn = x
        pl = pr = p
        gl = gr = g
        n, go, depth, a, k = 1, True, 0, 0.0, 1
        while go and depth < 8:
            way = 1 if rng.random() < 0.5 else -1
            if way < 0:
                ql, pl, gl, _, _, _, q1, n1, go1, a, k = tree(ql, pl, gl, log_u, way, depth, e, h0)
            else:
                _, _, _, qr, pr, gr, q1, n1, go1, a, k = tree(qr, pr, gr, log_u, way, depth, e, h0)
            if go1 and rng.random() < n1 / n:
                qn = q1
            n += n1
            go = go1 and (qr - ql) @ pl >= 0 and (qr - ql) @ pr >= 0
            depth += 1
        x = qn
        v, g = f(x)
        losses.append(-v)
        if i <= o.warmup:
            w = 1 / (i + 10)
            hbar = (1 - w) * hbar + w * (0.8 - a / k)
            log_e = anchor - np.sqrt(i) / 0.05 * hbar
            bar = np.exp(i**-0.75 * log_e + (1 - i**-0.75) * np.log(bar))
            e = np.exp(log_e)
        else:
            e = bar
            theta = np.exp(x[: model.g] - x[: model.g].max())
            draws.append(theta / theta.sum())
    return np.array(draws), np.ones(model.g), losses


FITS = {"vi": fit_vi, "mle": fit_map, "nuts": fit_nuts}


def split_r_hat(draws: np.ndarray) -> np.ndarray:
    """Split-chain potential scale reduction of each column."""
    half = len(draws) // 2
    if half < 2:
        return np.full(draws.shape[1], np.nan)
    parts = np.stack([draws[:half], draws[half : 2 * half]])
    within, between = parts.var(1, ddof=1).mean(0), half * parts.mean(1).var(0, ddof=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.sqrt(((half - 1) / half * within + between / half) / within)


def effective_size(draws: np.ndarray) -> np.ndarray:
    """Effective number of draws of each column: autocorrelations are summed in pairs while their sum is positive."""
    n = len(draws)
    x = draws - draws.mean(0)
    out = np.full(draws.shape[1], float(n))
    spectrum = np.fft.rfft(x, 2 * n, axis=0)
    acov = np.fft.irfft(np.abs(spectrum) ** 2, axis=0)[:n] / n
    for i in range(draws.shape[1]):
        if acov[0, i] <= 0:
            continue
        rho = acov[: n - n % 2, i] / acov[0, i]
        pairs = np.minimum.accumulate(rho[::2] + rho[1::2])
        total = pairs[: int(np.argmax(pairs <= 0)) if (pairs <= 0).any() else len(pairs)].sum()
        out[i] = min(float(n), n / max(2 * total - 1, 1 / n))
    return out


#: References of one set that the fits take: their matrix is dense in each task.
MAX_REFERENCES = 4096


@dataclass
class Fits:
    """composition: a row per sample and genome; loss: sample, step, loss; chains: sample, genome_id, r_hat, n_eff (null but for nuts)."""

    composition: DataFrame
    loss: DataFrame
    chains: DataFrame


def infer(observed: DataFrame, translation: DataFrame, matrix: DataFrame, options: InferenceOptions = InferenceOptions()) -> Fits:
    """Compositions and loss traces of samples.

    observed: sample, refseq, n; translation: genome, refseq, weight; matrix: src, dst, p. The matrices are those of one
    reference set; they are counted, then sent to every task once in sparse form. Samples are fitted in parallel.
    For larger sets use composition.em, which has no such limit.
    """
    spark = observed.sparkSession
    n_refs = translation.select("refseq").distinct().limit(MAX_REFERENCES + 1).count()
    if n_refs > MAX_REFERENCES:
        raise ValueError(f"more than {MAX_REFERENCES} references; use composition.em")
    # at most the square of the checked number of references
    known = translation.select("refseq").distinct()
    m = matrix.join(known.toDF("src"), "src", "left_semi").join(known.toDF("dst"), "dst", "left_semi").select("src", "dst", "p").toPandas()
    t = translation.select("genome", "refseq", "weight").toPandas()
    genomes, refs = sorted(t["genome"].unique()), sorted(t["refseq"].unique())
    gi, ri = {g: i for i, g in enumerate(genomes)}, {r: i for i, r in enumerate(refs)}
    cells = lambda df, a, ai, b, bi, v: (df[a].map(ai).to_numpy(np.int32), df[b].map(bi).to_numpy(np.int32), df[v].to_numpy(float))
    shared = spark.sparkContext.broadcast((genomes, refs, cells(t, "genome", gi, "refseq", ri, "weight"), cells(m, "src", ri, "dst", ri, "p")))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        genomes, refs, t_cells, m_cells = shared.value
        tm, mm = np.zeros((len(genomes), len(refs))), np.zeros((len(refs), len(refs)))
        for dense, (i, j, v) in ((tm, t_cells), (mm, m_cells)):
            dense[i, j] = v
        places = {r: i for i, r in enumerate(refs)}
        y = np.zeros(len(refs))
        found = pdf[pdf["refseq"].isin(places)]
        np.add.at(y, found["refseq"].map(places).to_numpy(int), found["n"].to_numpy(float))
        sample = pdf["sample"].iloc[0]
        if not y.sum():
            raise ValueError(f"sample {sample} has no mapped reads")
        owner = np.argmax(tm > 0, axis=0)
        share = np.bincount(owner, y / y.sum(), len(genomes))
        start = np.maximum(share, 1e-4)
        draws, presence, losses = FITS[options.mode](Model(tm, mm, y, options), start / start.sum(), options)
        chain = options.mode == "nuts"
        r_hat, n_eff = (split_r_hat(draws), effective_size(draws)) if chain else [np.full(len(genomes), np.nan)] * 2
        rows = [(sample, g, k, float(d[i]), share[i], float(presence[i]), float(r_hat[i]), float(n_eff[i]), None, None) for k, d in enumerate(draws) for i, g in enumerate(genomes)]
        rows += [(sample, None, None, None, None, None, None, None, k, float(v)) for k, v in enumerate(losses)]
        return pd.DataFrame(rows, columns=["sample", "genome_id", "draw", "theta", "observed", "presence", "r_hat", "n_eff", "step", "loss"])

    schema = "sample string, genome_id string, draw int, theta double, observed double, presence double, r_hat double, n_eff double, step int, loss double"
    fits = written(observed.select("sample", "refseq", "n").groupBy("sample").applyInPandas(fit, schema), "fits")
    draws = fits.where("genome_id is not null")
    facts = draws.groupBy("sample", "genome_id").agg(F.first("observed").alias("observed_rel_abundance"), F.first("presence").alias("presence_prob"), F.first("r_hat").alias("r_hat"), F.first("n_eff").alias("n_eff"))
    out = posterior_summary(draws, ["sample", "genome_id"]).join(facts, ["sample", "genome_id"])
    none = F.lit(None).cast("double")
    point = options.mode == "mle"
    composition = out.select(
        "sample", "genome_id", "observed_rel_abundance", F.col("mean").alias("inferred_mean"), (none if point else F.col("lo")).alias("inferred_lo"),
        (none if point else F.col("hi")).alias("inferred_hi"), (F.col("presence_prob") if options.presence else none).alias("presence_prob"),
    )
    number = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return Fits(composition, fits.where("step is not null").select("sample", "step", "loss"), facts.select("sample", "genome_id", number("r_hat"), number("n_eff")))


def diagnostics(observed: DataFrame, mean_diagonal: DataFrame, options: InferenceOptions, fits: Fits, min_identity: float | None = None, group_id: str | None = None, matrix_path: str | None = None) -> DataFrame:
    """One row per sample: options, reads, mean diagonal of the matrix and the fit's own figures as JSON values."""
    n = observed.groupBy("sample").agg(F.sum("n").alias("n_reads"))
    last = fits.loss.groupBy("sample").agg(F.max_by("loss", "step").alias("final_loss"))
    present = fits.composition.groupBy("sample").agg(F.count_if(F.col("presence_prob") >= 0.5).alias("n_present"))
    in_order = lambda c: F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("genome_id", c))), lambda x: x[c]))
    chains = fits.chains.groupBy("sample").agg(F.max("r_hat").alias("max_r_hat"), in_order("r_hat").alias("r_hat"), in_order("n_eff").alias("n_eff"))
    lit = lambda v, kind: F.lit(v).cast(kind)
    names = ("max_r_hat", "r_hat", "n_eff") if options.mode == "nuts" else ("final_loss", "n_present") if options.presence else ("final_loss",)
    extra = F.create_map(*(x for c in names for x in (F.lit(c), F.col(c).cast("string"))))
    out = n.join(last, "sample").join(present, "sample").join(chains, "sample").join(F.broadcast(mean_diagonal))  # one row
    return out.select(
        "sample", lit(options.mode, "string").alias("mode"), lit(options.likelihood, "string").alias("likelihood"), lit(options.use_mismapping, "boolean").alias("use_mismapping"),
        lit(min_identity, "double").alias("min_identity"), lit(options.presence, "boolean").alias("use_presence"), lit(options.presence_prior, "double").alias("presence_prior"),
        lit(options.presence_temp, "double").alias("presence_temp"), lit(group_id, "string").alias("mismapping_group_id"), lit(matrix_path, "string").alias("mismapping_matrix_path"),
        "n_reads", "mean_diagonal", extra.alias("extra"),
    )
