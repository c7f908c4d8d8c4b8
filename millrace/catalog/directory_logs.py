"""Directory-monitor analytics."""

from __future__ import annotations

from millrace.operators import dirlog
from millrace.plans.durable import staged
from millrace.registry import query
from millrace.sources.readers import read_log_folders


def _files(spark, folder):
    """The events written as logs, read back from the text files."""
    return dirlog.file_list(read_log_folders(spark, dirlog.write_logs(dirlog.log_lines(spark, folder))))


@query("dir1_parse_directory_log", f"""WITH {dirlog.SQL_FILE_LIST}
  SELECT loop_no, loop_ts, host_name, file_name, file_ext, file_size, file_ts, filename_ts FROM filelist""")
def dir1(spark, folder):
    return _files(spark, folder)


@query("dir2_file_summary", f"WITH {dirlog.SQL_FILE_SUMMARY} SELECT * FROM file_summary")
def dir2(spark, folder):
    return dirlog.file_summary(_files(spark, folder))


@query("dir3_loop_summary", f"""WITH {dirlog.SQL_LOOP_SUMMARY} SELECT af.loop_no, af.loop_ts, af.host_name,
  all_file_count, all_file_size, ob_file_count, ob_file_size, ob_file_oldest_ts, ob_file_latest_ts,
  CAST(date_diff('second', CAST(ob_file_oldest_ts AS TIMESTAMP), CAST(af.loop_ts AS TIMESTAMP)) AS BIGINT) AS ob_file_oldest_age,
  CAST(date_diff('second', CAST(ob_file_latest_ts AS TIMESTAMP), CAST(af.loop_ts AS TIMESTAMP)) AS BIGINT) AS ob_file_latest_age
  FROM af JOIN df ON af.loop_no = df.loop_no""")
def dir3(spark, folder):
    return dirlog.loop_summary(staged(_files(spark, folder), "files"))
