"""Embedders by name.

An embedder is a factory called once in each Python worker; it returns a function from a list of sequences to a
2-D array. ``kmer`` works offline and is deterministic. The model families need libraries and weights that are
loaded only when asked for; code that comes with a model runs only if ``trust_remote_code`` is set.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np

Encode = Callable[[Sequence[str]], np.ndarray]
_FACTORIES: dict[str, Callable[..., Encode]] = {}


def register(name: str):
    def add(factory: Callable[..., Encode]):
        _FACTORIES[name.lower()] = factory
        return factory

    return add


def names() -> list[str]:
    return sorted(_FACTORIES)


def load(name: str, **options) -> Encode:
    """The embedder of a name, in any letter case."""
    try:
        factory = _FACTORIES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown embedder {name!r}; known are {', '.join(names())}") from None
    return factory(**options)


def to_vector(x) -> np.ndarray:
    """One float32 vector; a batch of one is unpacked, any other shape is an error."""
    if hasattr(x, "detach"):
        x = x.detach().cpu().float().numpy()
    a = np.asarray(x)
    if a.ndim == 2 and a.shape[0] == 1:
        a = a[0]
    if a.ndim != 1:
        raise ValueError(f"expected one vector, got shape {a.shape}")
    return a.astype(np.float32)


@register("kmer")
def kmer(k: int = 3) -> Encode:
    """Relative frequencies of the 4 ** k words of A, C, G and T; words with other letters are not counted."""
    code = np.full(256, -1)
    for i, c in enumerate(b"ACGT"):
        code[[c, c + 32]] = i

    def one(seq: str) -> np.ndarray:
        x = code[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
        out = np.zeros(4**k)
        n = len(x) - k + 1
        if n > 0:
            word, ok = np.zeros(n, np.int64), np.ones(n, bool)
            for i in range(k):
                word = word * 4 + x[i : i + n]
                ok &= x[i : i + n] >= 0
            out = np.bincount(word[ok], minlength=4**k) / max(1, int(ok.sum()))
        return out.astype(np.float32)

    return lambda seqs: np.stack([one(s) for s in seqs]) if len(seqs) else np.zeros((0, 4**k), np.float32)


def _pool(hidden, mask, pooling: str):
    if pooling == "mean":
        m = mask.unsqueeze(-1)
        return (hidden * m).sum(1) / m.sum(1).clamp(min=1)
    if pooling == "last":
        return hidden[range(len(hidden)), mask.sum(1) - 1]
    raise ValueError(f"unknown pooling: {pooling}")


def max_tokens(tokenizer, model) -> int | None:
    """What a model takes at most, of what its tokenizer and its configuration tell; None if neither does."""
    told = [
        getattr(tokenizer, "model_max_length", None),
        getattr(getattr(model, "config", None), "max_position_embeddings", None)
    ]
    known = [int(x) for x in told if x and x < 1 << 30]
    return min(known) if known else None


def _transformer(
    auto: str, model_name_or_path: str, device: str, pooling: str, local_files_only: bool, trust_remote_code: bool,
    half: bool = False, trim: int = 1, start_token: bool = False, attention: str | None = None
) -> Encode:
    if pooling not in ("mean", "last"):
        raise ValueError(f"unknown pooling: {pooling}")
    try:
        import torch
        import transformers
    except ImportError as e:
        raise ImportError("this embedder needs torch and transformers") from e
    own = {"local_files_only": local_files_only, "trust_remote_code": trust_remote_code}
    path = str(Path(model_name_or_path).expanduser()) if Path(model_name_or_path).expanduser().exists() else model_name_or_path
    tokenizer = transformers.AutoTokenizer.from_pretrained(path, **own)
    if tokenizer.pad_token is None:
        tokenizer.pad_token = tokenizer.eos_token
    tokenizer.padding_side = "right"  # the last token of a sequence is found by its length
    more = ({"torch_dtype": torch.float16} if half else {}) | ({"attn_implementation": attention} if attention else {})
    model = getattr(transformers, auto).from_pretrained(path, **own, **more).to(device).eval()
    most = max_tokens(tokenizer, model)
    cut = {"truncation": True, "max_length": most} if most else {"truncation": False}

    def encode(seqs: Sequence[str]) -> np.ndarray:
        texts = [(tokenizer.bos_token or "") * start_token + s[: len(s) - len(s) % trim] for s in seqs]
        batch = tokenizer(texts, return_tensors="pt", padding="longest", **cut).to(device)
        with torch.inference_mode():
            out = model(**batch, output_hidden_states=True)
        return _pool(out.hidden_states[-1].float(), batch["attention_mask"], pooling).cpu().numpy()

    return encode


@register("generator")
def generator(
    model_name_or_path: str, device: str = "cpu", pooling: str = "mean", local_files_only: bool = True,
    trust_remote_code: bool = False
) -> Encode:
    """Causal model over six-letter words: sequences are cut to whole words after a start token."""
    return _transformer(
        "AutoModelForCausalLM", model_name_or_path, device, pooling, local_files_only, trust_remote_code, trim=6,
        start_token=True
    )


@register("nt")
def nt(
    model_name_or_path: str, device: str = "cpu", pooling: str = "mean", local_files_only: bool = True,
    trust_remote_code: bool = False
) -> Encode:
    """Masked model of nucleotides."""
    return _transformer(
        "AutoModelForMaskedLM", model_name_or_path, device, pooling, local_files_only, trust_remote_code
    )


@register("agront")
def agront(
    model_name_or_path: str, device: str = "cpu", pooling: str = "mean", local_files_only: bool = True,
    trust_remote_code: bool = False
) -> Encode:
    """Masked model of plant nucleotides."""
    return _transformer(
        "AutoModelForMaskedLM", model_name_or_path, device, pooling, local_files_only, trust_remote_code
    )


@register("rice8k")
def rice8k(
    model_name_or_path: str, device: str = "cpu", pooling: str = "mean", local_files_only: bool = True,
    trust_remote_code: bool = False, attention: str | None = None
) -> Encode:
    """Half-precision model without a head; on a graphics card it uses the fast attention kernels unless told others."""
    fast = device != "cpu"
    return _transformer(
        "AutoModel", model_name_or_path, device, pooling, local_files_only, trust_remote_code, half=fast,
        attention=attention or ("flash_attention_2" if fast else None)
    )


@register("evo2")
def evo2(
    model_name_or_path: str, device: str = "cuda:0", pooling: str = "mean", layer: str = "blocks.28.mlp.l3",
    local_files_only: bool = True
) -> Encode:
    """A named layer of a model loaded from a local weights file."""
    path = Path(model_name_or_path).expanduser()
    if path.suffix != ".pt" or not path.exists():
        raise ValueError("this embedder loads a local .pt file")
    try:
        import torch
        from evo2 import Evo2
    except ImportError as e:
        raise ImportError("this embedder needs torch and evo2") from e
    model = Evo2(path.stem, local_path=str(path))

    def encode(seqs: Sequence[str]) -> np.ndarray:
        rows = []
        for s in seqs:
            ids = torch.tensor(model.tokenizer.tokenize(s), dtype=torch.int).unsqueeze(0).to(device)
            _, layers = model(ids, return_embeddings=True, layer_names=[layer])
            h = layers[layer].float()
            rows.append(to_vector(h.mean(1) if pooling == "mean" else h[:, -1]))
        return np.stack(rows)

    return encode
