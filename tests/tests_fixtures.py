"""Payloads of the sources; a field given as ... is left out."""


def review(**over):
    base = {"id": {"label": "r1"}, "author": {"name": {"label": "Bo"}, "uri": {"label": "https://x"}, "label": ""}, "updated": {"label": "2025-01-02T03:04:05-07:00"}, "title": {"label": "Hi"},
            "content": {"label": "text", "attributes": {"type": "text"}}, "im:rating": {"label": "4"}, "im:voteCount": {"label": "3"}, "im:voteSum": {"label": "1"}, "other": [1]}
    base.update(over)
    return {k: v for k, v in base.items() if v is not ...}


def post(**over):
    return {k: v for k, v in {"id": "a1", "name": "t3_a1", "permalink": "/r/x/a1/", "title": "T", "created_utc": 1700000000.0, "author": "ann", "author_fullname": "t2_9", "score": 3, "num_comments": 6, **over}.items() if v is not ...}


def comment(n, replies="", **over):
    return {"kind": "t1", "data": {k: v for k, v in {"id": n, "name": f"t1_{n}", "body": n, "created_utc": 1, "replies": replies, **over}.items() if v is not ...}}
