"""The remote folder source against a fixture service."""

from tillspark.sources.remote import RemoteImages


def lister(folder, token):
    return [] if folder == "none" else [("1", "b.jpg", "image/jpeg"), ("2", "notes.txt", "text/plain"), ("3", "a.PNG", None), ("4", "scan", "image/heic")]


def fetcher(file_id, token):
    if file_id == "4":
        raise OSError("gone")
    return f"{file_id}-{token}".encode()


def test_remote_images(spark):
    spark.dataSource.register(RemoteImages)
    load = lambda folder: spark.read.format("remote_images").option("folder", folder).option("token", "t").option("lister", "tests.test_remote:lister").option("fetcher", "tests.test_remote:fetcher").load()
    got = {r["name"]: (r["id"], bytes(r["content"]) if r["content"] is not None else None, r["error"]) for r in load("f").collect()}
    assert got == {"a.PNG": ("3", b"3-t", None), "b.jpg": ("1", b"1-t", None), "scan": ("4", None, "OSError: gone")}
    assert load("none").count() == 0
