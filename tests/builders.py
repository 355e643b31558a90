"""Small consistent document sets, made in code; a test breaks one thing in a copy."""

from __future__ import annotations

import copy
import hashlib
import json

#: Keys, kinds and roles in the documents below are those of the contracts.
STAMP = "2024-05-01T10:00:00Z"


def sha(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def raw(doc) -> bytes:
    return doc if isinstance(doc, bytes) else json.dumps(doc).encode()


def annotation(key: str, item: str, image: bytes, **changes) -> dict:
    doc = {
        "schema_version": "1.0.0", "id": f"{key}-ann", "item_id": item, "image_sha256": sha(image), "ontology_id": "ont", "ontology_version": "1", "created_at": STAMP, "status": "approved",
        "source": {"kind": "human", "actor_id": "a", "run_id": "r", "tool_version": "t"},
        "review": {"reviewer_id": "p", "reviewed_at": STAMP, "reason": "ok"},
        "objects": [{"id": "o1", "class_id": "c1", "bbox": [1, 2, 10, 20]}, {"id": "o2", "class_id": "c2", "bbox": [0, 0, 40.5, 30]}],
    }
    return doc | changes


def dataset_case(name: str, items: int = 3, change=None, change_annotation=None, extra=None) -> list[tuple[str, bytes]]:
    """(document, content) of a manifest with its images and annotations under the folder ``name``.

    ``change_annotation`` is applied to the first annotation before it is hashed, ``change`` to the manifest.
    """
    files, entries = [], []
    for k in range(items):
        image = f"{name} image {k}".encode()
        ann = annotation(f"{name}-{k}", f"{name}-item-{k}", image)
        if k == 0 and change_annotation:
            ann = copy.deepcopy(ann)
            ann = change_annotation(ann) or ann
        content = raw(ann)
        files += [(f"{name}/images/{k}.png", image), (f"{name}/annotations/{k}.json", content)]
        entries.append({
            "id": f"{name}-item-{k}", "image": {"path": f"images/{k}.png", "sha256": sha(image)}, "width": 64, "height": 48, "group_id": f"g{k}", "split": "train" if k else "validation",
            "provenance": {"source_ref": "s", "acquired_at": STAMP}, "annotation": {"id": f"{name}-{k}-ann", "artifact": {"path": f"annotations/{k}.json", "sha256": sha(content)}},
        })
    doc = {"schema_version": "1.0.0", "id": f"{name}-ds", "version": "1", "created_at": STAMP, "ontology": {"id": "ont", "version": "1", "classes": [{"id": "c1", "label": "one"}, {"id": "c2", "label": "two"}]}, "items": entries}
    if change:
        doc = copy.deepcopy(doc)
        doc = change(doc) or doc
    files.append((f"{name}/dataset.json", raw(doc)))
    return files + list(extra or [])


def event(name: str, change=None) -> tuple[str, bytes]:
    doc = {
        "schema_version": "1.0.0", "event_id": name, "captured_at": STAMP, "emitted_at": STAMP, "source": {"id": "cam", "kind": "image", "session_id": "s", "frame_index": 0},
        "model": {"package_id": "pkg", "manifest_sha256": "a" * 64}, "image": {"width": 64, "height": 48}, "detections": [{"bbox": [1, 1, 5, 5], "class_id": "c1", "label": "one", "confidence": 0.5}],
    }
    if change:
        doc = change(doc) or doc
    return name, raw(doc)


def package_case(name: str, change=None, change_record=None, change_labels=None, change_dataset=None, after=None) -> list[tuple[str, str, bytes]]:
    """(package, path, content) of a package whose runs tie together. Changes apply before hashing:
    ``change_record`` to (stage, record), ``change`` to the manifest; ``after`` to the finished files."""
    files = {path.removeprefix(f"{name}/"): content for path, content in dataset_case(name, change=change_dataset)}
    files["model.bin"], files["best.pt"], files["probe.json"], files["metrics.txt"] = b"model " + name.encode(), b"weights " + name.encode(), b"probe", b"metrics"
    ref = lambda path: {"path": path, "sha256": sha(files[path])}
    labels = {"schema_version": "1.0.0", "ontology_id": "ont", "ontology_version": "1", "classes": [{"output_index": 0, "id": "c1", "label": "one"}, {"output_index": 3, "id": "c2", "label": "two"}]}
    files["labels.json"] = raw((change_labels(labels) or labels) if change_labels else labels)
    files["preprocessing.json"] = raw({"schema_version": "1.0.0", "input_name": "images", "dtype": "float32", "layout": "NCHW", "color_space": "RGB", "width": 64, "height": 64, "resize": {"mode": "stretch", "interpolation": "bilinear"}, "normalization": {"scale": 0.5, "mean": [0, 0, 0], "std": [1, 1, 1]}})
    io = lambda role, path: {"role": role, "artifact": ref(path)}
    runs = {
        "training": ({"epochs": 3}, [io("dataset", "dataset.json")], [io("model", "best.pt")], {"mAP50": 0.5}),
        "evaluation": ({"split": "validation", "metric_definitions": {"mAP50": "mean"}, "thresholds": {"iou": 0.5}, "sample_count": 1}, [io("dataset", "dataset.json"), io("model", "best.pt")], [io("metrics", "metrics.txt")], {"mAP50": 0.5}),
        "export": ({"opset": 17}, [io("model", "best.pt")], [io("model", "model.bin"), io("probe", "probe.json")], None),
    }
    for stage, (config, inputs, outputs, metrics) in runs.items():
        record = {"schema_version": "1.0.0", "id": f"{name}-{stage}", "stage": stage, "created_at": STAMP, "implementation": {"name": "n", "version": "1", "code_revision": "r"}, "config": config, "inputs": inputs, "outputs": outputs}
        record |= {"metrics": metrics} if metrics else {}
        if change_record:
            record = change_record(stage, record) or record
        files[f"records/{stage}.json"] = raw(record)
    manifest = {
        "schema_version": "1.0.0", "package_id": name, "created_at": STAMP, "task": "object_detection", "model": {"artifact": ref("model.bin"), "format": "onnx", "adapter": {"id": "ad", "version": "1", "config": {"max_det": 300}}},
        "labels": ref("labels.json"), "preprocessing": ref("preprocessing.json"), "postprocessing": {"output_contract": "adapter_detections_v1", "confidence_threshold": 0.25, "nms": {"mode": "class_aware", "iou_threshold": 0.5}},
        "trace": {"dataset": {"id": f"{name}-ds", "version": "1", "artifact": ref("dataset.json")}} | {s: {"id": f"{name}-{s}", "artifact": ref(f"records/{s}.json")} for s in runs},
    }
    if change:
        manifest = change(manifest) or manifest
    files["manifest.json"] = raw(manifest)
    if after:
        after(files)
    return [(name, path, content) for path, content in files.items()]
