import json
import os


def nested(entries):
    return {"Data": {"RootChunk": {"root": {"Data": {"entries": entries}}}}}


def write_docs(root, files: dict):
    """files: relative path -> JSON-able object, str or bytes."""
    for rel, data in files.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if isinstance(data, bytes):
            raw = data
        elif isinstance(data, str):
            raw = data.encode("utf-8")
        else:
            raw = json.dumps(data).encode("utf-8")
        with open(path, "wb") as f:
            f.write(raw)
    return root


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return [tuple(r) for r in out.collect()]
