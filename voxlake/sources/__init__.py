"""Readers and writers of the pipeline's own file formats."""

from .documents import list_media, list_runs, pending, quarantine, read_path_list, read_pipe_corpus, read_segments, split_quarantine, write_path_list, write_segments, write_text

__all__ = ["list_media", "list_runs", "pending", "quarantine", "read_path_list", "read_pipe_corpus", "read_segments", "split_quarantine", "write_path_list", "write_segments", "write_text"]
