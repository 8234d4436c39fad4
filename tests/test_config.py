import pytest
import yaml

from lodestone import config as C

# A family of nine arms as such projects keep them: a base that states everything, arms that extend it, and points of a sweep.
BASE = {
    "project": "arms", "seed": 42,
    "model": {"name": "org/tiny-0.5b-chat", "revision": "main", "trust_remote_code": False, "max_seq_length": 1024, "dtype": "bfloat16", "attn_implementation": "sdpa"},
    "data": {"source": "org/questions", "source_type": "hf", "split": "train", "version": "v1.0", "max_examples": 5000, "train_ratio": 0.8, "val_ratio": 0.1, "test_ratio": 0.1, "local_dir": "x", "delta": {"enabled": False, "catalog": "lake"}},
    "training": {"method": "full", "epochs": 1, "learning_rate": 2.0e-5, "per_device_train_batch_size": 4, "gradient_accumulation_steps": 4, "save_steps": None, "optim": "adamw_torch"},
    "quantization": {"enabled": False, "bits": 4, "quant_type": "nf4", "double_quant": True},
    "evaluation": {"metrics": ["rouge_l", "token_f1", "exact_match"], "latency_batch_sizes": [1], "generation": {"max_new_tokens": 256, "do_sample": False}, "gpu_hourly_usd": 0.6},
    "selection": {"weights": {"quality": 0.55, "latency": 0.2, "memory": 0.15, "model_size": 0.05, "cost": 0.05}, "max_latency_ms": None},
    "tracking": {"experiment_name": "/Shared/arms", "run_name": None, "registry_uri": None, "tags": {}},
}
LORA = {"r": 8, "alpha": 16, "dropout": 0.05, "bias": "none", "task_type": "CAUSAL_LM", "target_modules": ["q", "k", "v", "o"]}
WIDE = {"r": 16, "alpha": 32, "target_modules": ["q", "k", "v", "o", "up", "down"]}
ARMS = {
    "base": BASE,
    "baseline": {"extends": "base.yaml", "training": {"epochs": 0, "max_steps": 0}, "tracking": {"run_name": "zero-shot", "tags": {"trains": "false"}}},
    "full_ft": {"extends": "base.yaml", "training": {"per_device_train_batch_size": 2, "gradient_accumulation_steps": 8, "weight_decay": 0.01}},
    "lora": {"extends": "base.yaml", "training": {"method": "lora", "epochs": 2, "learning_rate": 2.0e-4}, "lora": LORA, "tracking": {"tags": {"arm": "lora"}}},
    "lora_r16": {"extends": "lora.yaml", "lora": WIDE, "tracking": {"tags": {"sweep": "rank"}}},
    "qlora": {"extends": "base.yaml", "training": {"method": "qlora", "optim": "paged"}, "quantization": {"enabled": True}, "lora": LORA},
    "qlora_r16": {"extends": "qlora.yaml", "lora": WIDE},
    "cpu": {"extends": "lora.yaml", "model": {"max_seq_length": 512, "dtype": "float32"}, "training": {"max_steps": 30, "per_device_train_batch_size": 2, "eval_steps": None, "bf16": False}, "evaluation": {"generation": {"max_new_tokens": 96}}},
    "smoke": {"extends": "lora.yaml", "model": {"name": "tiny/random", "max_seq_length": 128}, "data": {"version": "smoke", "max_examples": 64}, "lora": {"r": 4, "alpha": 8, "target_modules": ["q"]}, "tracking": {"log_model": False}},
}


@pytest.fixture
def arms(tmp_path):
    for name, held in ARMS.items():
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump(held))
    return tmp_path


@pytest.mark.parametrize(
    "name, slug, batch, scaling",
    [
        ("base", "tiny-0.5b-chat-full-v1.0", 16, None), ("baseline", "tiny-0.5b-chat-full-v1.0", 16, None), ("full_ft", "tiny-0.5b-chat-full-v1.0", 16, None), ("lora", "tiny-0.5b-chat-lora-r8a16-v1.0", 16, 2.0),
        ("lora_r16", "tiny-0.5b-chat-lora-r16a32-v1.0", 16, 2.0), ("qlora", "tiny-0.5b-chat-qlora-r8a16-4bit-v1.0", 16, 2.0), ("qlora_r16", "tiny-0.5b-chat-qlora-r16a32-4bit-v1.0", 16, 2.0), ("cpu", "tiny-0.5b-chat-lora-r8a16-v1.0", 8, 2.0),
        ("smoke", "random-lora-r4a8-smoke", 16, 2.0),
    ],
)
def test_every_arm_loads_and_round_trips(arms, name, slug, batch, scaling):
    c = C.load_config(arms / f"{name}.yaml", env={})
    flat = c.flat_params()
    assert (c.run_slug, flat["training.effective_batch_size"], flat.get("lora.scaling")) == (slug, batch, scaling)
    assert flat["tracking.registry_uri"] == "null" and flat["evaluation.latency_batch_sizes"] == "[1]" and flat["selection.weights.cost"] == 0.05
    assert C.load_config(C.dump_config(c, arms / "out" / "c.yaml"), env={}) == c


def test_layers(arms):
    wide = C.load_config(arms / "lora_r16.yaml", env={})
    assert wide.tracking.tags == {"arm": "lora", "sweep": "rank"} and wide.lora.dropout == 0.05 and wide.training.epochs == 2
    assert C.load_config(arms / "cpu.yaml", env={}).training.eval_steps is None
    back = C.load_config(arms / "lora.yaml", {"lora": None, "training.method": "full"}, {})
    assert back.lora is None and back.flat_params()["lora"] == "null"
    assert C.load_config(arms / "lora.yaml", {"lora": {"r": 2}}, {}).lora == C.LoraConfig(r=2)
    assert C.load_config(overrides={"selection.weights": {"quality": 1}}, env={}).selection.weights == {"quality": 1.0}
    assert wide.data.delta.fqn("gold", wide.data.delta.table_train) == "lake.lodestone_gold.train"
    assert wide.data.salt == "v1.0:42"
    assert len(C.load_config(overrides={"project": "x" * 600}, env={}).flat_params()["project"]) == C.PARAM_CHARS


def test_overrides_and_environment(arms):
    assert C.parse_overrides("a.b=1,c=true,d=x,e=[1,2],f=1e-4,g=none") == {"a.b": 1, "c": True, "d": "x", "e": [1, 2], "f": 1e-4, "g": None}
    env = {"LODESTONE__TRAINING__EPOCHS": "3", "lodestone__data__max_examples": "null", "OTHER": "x"}
    c = C.load_config(arms / "lora.yaml", {"training.epochs": 7, "training.learning_rate": "1e-3"}, env)
    assert (c.training.epochs, c.training.learning_rate, c.data.max_examples) == (3.0, 1e-3, None)
    assert C.load_config(overrides={"evaluation.metrics": ["token_f1"]}, env={}).evaluation.metrics == ("token_f1",)


@pytest.mark.parametrize(
    "bad",
    [
        {"training.method": "lora"}, {"lora": {"r": 4}}, {"training.method": "qlora", "lora": {}}, {"training.use_cpu": True}, {"nope": 1}, {"data.delta.x": 1}, {"seed": -1}, {"model.max_seq_length": 32}, {"model.max_seq_length": 9000}, {"training.warmup_ratio": 1},
        {"training.learning_rate": 0}, {"training.fp16": True}, {"lora.r": 300, "training.method": "lora"}, {"quantization.bits": 5}, {"model.dtype": "int8"}, {"data.source_type": "ftp"}, {"data.train_ratio": 0.9}, {"evaluation.max_eval_samples": 0},
        {"selection.tie_breaker": "name"}, {"training.epochs": "many"}, {"tracking.tags": {"a": 1}}, {"data.max_examples": 1.5}, {"data": 3},
    ],
)
def test_mistakes_are_errors(bad):
    with pytest.raises(ValueError):
        C.load_config(overrides=bad, env={})


def test_files_that_cannot_be_read(tmp_path):
    (tmp_path / "a.yaml").write_text("extends: b.yaml")
    (tmp_path / "b.yaml").write_text("extends: a.yaml")
    (tmp_path / "list.yaml").write_text("- 1")
    (tmp_path / "empty.yaml").write_text("")
    (tmp_path / "c.json").write_text('{"seed": 3}')
    for name in ("a", "list"):
        with pytest.raises(ValueError):
            C.load_config(tmp_path / f"{name}.yaml", env={})
    with pytest.raises(FileNotFoundError):
        C.load_config(tmp_path / "none.yaml", env={})
    assert C.load_config(tmp_path / "empty.yaml", env={}) == C.Config() and C.load_config(tmp_path / "c.json", env={}).seed == 3
    with pytest.raises(ValueError):
        C.parse_overrides("x")
